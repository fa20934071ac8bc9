"""Terms, differences of runs and streamed arrivals, on small cases and with a hot key."""

import random
from collections import Counter
from datetime import date, timedelta

from pyspark.sql import functions as F

from docloom.operators.compare import changes, difference
from docloom.operators.terms import in_force, newest_term, read_terms, unbroken_cover
from docloom.sources.arrivals import first_arrivals, take_arrivals

DAY = date(2020, 1, 1)
TERM = "insured string, policy_number string, starts date, ends date"


def day(n):
    return DAY + timedelta(days=n)


def some_terms(seed, n=400):
    """A third of the terms belong to one insured; some repeat."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        begin = rnd.randrange(3000)
        who = "hot" if i % 3 == 0 else f"i{rnd.randrange(40)}"
        rows.append((who, f"p{i}", day(begin), day(begin + rnd.choice([1, 5, 30, 365, 900]))))
    return rows + rows[:10]


def some_losses(seed, n=600):
    rnd = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else f"i{rnd.randrange(45)}", day(rnd.randrange(-50, 4100))) for i in range(n)]
    return rows + [(n, None, day(5)), (n + 1, "hot", None)]


def test_terms_in_force_are_those_of_brute_force(spark):
    terms, losses = some_terms(1), some_losses(2)
    dated = spark.createDataFrame(losses, "loss int, insured string, day date")
    found = in_force(dated, spark.createDataFrame(terms, TERM)).select("loss", "policy_number").collect()
    wanted = Counter((n, p) for n, who, on in losses for t, p, b, e in terms if who == t and on is not None and b <= on < e)
    assert Counter(tuple(row) for row in found) == wanted


def test_newest_term_is_that_of_brute_force(spark):
    terms, losses = some_terms(3), some_losses(4)
    dated = spark.createDataFrame(losses, "loss int, insured string, day date").withColumn("other", F.lit("kept"))
    found = {row.loss: (row.policy_number, row.starts, row.ends) for row in newest_term(dated, spark.createDataFrame(terms, TERM)).collect()}
    assert len(found) == len(losses)
    for n, who, on in losses:
        begun = [(b, e, p) for t, p, b, e in terms if who == t and on is not None and b <= on]
        b, e, p = max(begun, default=(None, None, None))
        assert found[n] == (p, b, e)


def test_unbroken_cover_is_that_of_days(spark):
    terms = some_terms(5, 120)
    found = unbroken_cover(spark.createDataFrame(terms, TERM)).orderBy("insured", "cover_starts").collect()
    wanted = []
    for who in sorted({t[0] for t in terms}):
        mine = sorted((b, e) for t, _, b, e in terms if t == who)
        stretches = []
        for b, e in mine:
            if stretches and b <= stretches[-1][1]:
                last = stretches[-1]
                stretches[-1] = (last[0], max(last[1], e), last[2] + 1, last[3] + (e - b).days)
            else:
                stretches.append((b, e, 1, (e - b).days))
        for i, (b, e, n, days) in enumerate(stretches):
            covered = (e - b).days
            wanted.append((who, b, e, n, covered, days - covered, (b - stretches[i - 1][1]).days if i else None))
    assert [tuple(row) for row in found] == wanted


def test_unreadable_and_reversed_terms_take_no_part(spark):
    rows = [("a", "1", "2025-01-01", "2026-01-01"), ("a", "2", "2025-01-01", "on cancellation"), ("a", "3", None, "2026-01-01"),
            ("a", "4", "2026-01-01", "2025-01-01"), (None, "5", "2025-01-01", "2026-01-01")]
    policies = spark.createDataFrame(rows, "named_insured string, policy_number string, effective_date string, expiration_date string")
    terms = read_terms(policies)
    assert [row.policy_number for row in terms.collect()] == ["1"]
    assert unbroken_cover(terms.limit(0)).isEmpty()


def test_difference_has_the_multiplicities_of_set_operations(spark):
    rnd = random.Random(6)
    rows = lambda: [(rnd.choice(["a", "b", None]), rnd.choice([1.0, 2.0, None])) for _ in range(60)]
    first, second = (spark.createDataFrame(rows(), "k string, v double") for _ in range(2))
    found = difference(first, second, ["k", "v"])

    def expanded(name):
        return Counter({(row.k, row.v): row[name] for row in found.collect() if row[name]})

    def counted(df):
        return Counter((row.k, row.v) for row in df.collect())

    assert expanded("removed") == counted(first.exceptAll(second))
    assert expanded("added") == counted(second.exceptAll(first))
    assert expanded("kept") == counted(first.intersectAll(second))
    for row in changes(found, ["k"]).collect():
        assert row.kept + row.changed + row.removed == first.filter(F.col("k").eqNullSafe(row.k)).count()
        assert row.kept + row.changed + row.added == second.filter(F.col("k").eqNullSafe(row.k)).count()


def test_arrivals_are_taken_once(spark, tmp_path):
    """Pages sent twice, in one call and in the next, and a second call that takes new files only."""
    schema = "file_path string, page_no int, page_text string"
    arriving, saved, progress = (str(tmp_path / name) for name in ("arriving", "saved", "progress"))

    def send(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(arriving)

    send([("/a", 1, "one"), ("/a", 2, None), ("/b", None, None)])
    send([("/a", 1, "one"), ("/c", 1, "x")])
    take_arrivals(spark, arriving, schema, saved, progress, files_at_once=1)
    assert spark.read.parquet(saved).count() == 4
    send([("/a", 2, None), ("/b", None, None), ("/d", 1, "new")])
    take_arrivals(spark, arriving, schema, saved, progress)
    assert spark.read.parquet(saved).count() == 5
    found = first_arrivals(spark.read.parquet(saved).unionByName(spark.read.parquet(saved)))
    assert sorted(found.collect(), key=str) == sorted(
        spark.createDataFrame([("/a", 1, "one"), ("/a", 2, None), ("/b", None, None), ("/c", 1, "x"), ("/d", 1, "new")], schema).collect(), key=str
    )
