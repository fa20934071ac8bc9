"""The filter audit, hard-negative mining and decontamination against plain versions, with every awkward row."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import Row, functions as F, types as T

from docloom.llm import filter_audit, hard_negatives
from docloom.llm.decontaminate import decontaminate, find_passages
from docloom.llm.filter_audit import CHECKS, RadixTrie, audit_filters, filter_masks
from docloom.llm.hard_negatives import hilbert, mine_hard_negatives, windows_of
from tests.llm.helpers import SCHEMA, edge_rows, frame

SPACES = re.compile("[^\x20\x09-\x0d]+")
NAMES = "low high labels block chunk row rows curve score anchor_id rank lows highs pairs".split()


def test_radix_trie():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(12))) for _ in range(3000)] + ["", "é" * 9, "x" * 100_000, "x" * 99_999 + "y"]
    trie, seen = RadixTrie(), {}
    for text in texts + texts[::-1]:
        assert seen.setdefault(text, place := trie.place(text)) == place
    assert len(set(seen.values())) == len(seen) == trie.size


def plain_masks(rows):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    found = []
    for i, text, part in rows:
        text = text or ""
        words = SPACES.findall(text)
        fails = [
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search("[#$%&*|]", text)), i is not None and least.get(text, i) < i,
        ]
        found.append((i, part or "", sum(f << n for n, f in enumerate(fails))))
    return sorted(found, key=repr)


def audit_rows():
    rows = [(i, t, "s") for i, t in edge_rows()]
    shared = "The same long beginning of many texts. " * 30
    rows += [(1000 + i, shared + str(i % 17), f"p{i % 3}") for i in range(80)]
    rows += [(2000 + i, "ONE TEXT of a third of all rows #", None if i % 2 else "p0") for i in range(120)]
    return rows + [(None, "ONE TEXT of a third of all rows #", "p1"), (7, None, None)]


@pytest.mark.parametrize("range_bytes", [8 << 20, 600, 1])
def test_masks(spark, monkeypatch, range_bytes):
    """Small ranges make prefixes grow, and salt the text that fills one."""
    monkeypatch.setattr(filter_audit, "GROWTH", 4)
    rows = audit_rows()
    extra = "least entry mask salt key found heavy".split()
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("text", "source", *extra)]
    ])
    docs = spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema).repartition(9)
    got = [(r.id, r.part, r["mask"]) for r in filter_masks(docs, range_bytes=range_bytes).collect()]
    assert sorted(got, key=repr) == plain_masks(rows)
    assert filter_masks(docs.limit(0)).count() == 0


def test_audit(spark):
    rows = audit_rows()
    labels = {i: (i % 2, i % 5 == 0) for i, *_ in rows if i is not None and i % 3}
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame(
        [(i, q, int(t)) for i, (q, t) in labels.items()] + [(None, 1, 1), (2000, None, None), (1001, 0, 0)], "doc_id long, quality int, toxic int"
    )
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit_filters(filter_masks(docs), marks, "ABCDE").collect()}
    masks, want = plain_masks(rows), {}
    for part in {p for _, p, _ in masks}:
        here = [(i, {c for n, c in enumerate("ABCDE") if m >> n & 1}) for i, p, m in masks if p == part]
        good, toxic = ({i for i, x in labels.items() if x[n] == 1} for n in (0, 1))
        shares = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, letter in enumerate(order, 1):
                gone, kept = [x for x in left if letter in x[1]], [x for x in left if letter not in x[1]]
                redundant = sum(letter in x[1] for x in here) - len(gone)
                want[part, "".join(order), step] = [
                    len(kept), len(gone), redundant, sum(x[1] == {letter} for x in here),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone),
                ]
                shares[letter] += len(gone)
                left = kept
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                want[part, "".join(order), step].append(shares[letter])
    assert got == {k: tuple(v) for k, v in want.items()}
    none = audit_filters(filter_masks(docs.limit(0)), marks, "ABCDE")
    assert none.count() == 0 and list(CHECKS) == list("ABCD")


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_hilbert_steps_to_a_neighbour(dims, bits):
    cells = np.array(list(itertools.product(range(2**bits), repeat=dims)))
    places = hilbert(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    ordered = cells[np.argsort(places)]
    assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


def vector_rows(n, width, seed=5, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, width))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 6))
        rows.append((i, (scale * (centres[rng.integers(0, 6)] + 0.4 * rng.standard_normal(width))).astype(np.float32).tolist(), label))
    nan, inf = float("nan"), float("inf")
    rows += [(n + 50 * k, rows[k][1], None if k == 1 else 3) for k in range(3)] + [(n + 1, None, 2), (n + 2, [nan] * width, 1)]
    rows += [(n + 3, [inf] + [1.0] * (width - 1), 1), (n + 4, [None] + [1.0] * (width - 1), 1), (n + 5, [], 1), (None, rows[0][1], 0)]
    return rows + [(n + 6 + i, rows[0][1], i % 2) for i in range(n // 3)] + [(5, rows[5][1], rows[5][2]), (n + 10_000, rows[1][1][:2], 4)]


def plain_negatives(rows, width):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = [math.floor(256 * x) for x in v] + [0] * (width - len(v)), label
    found = []
    for a in (i for i in kept if i % 50 == 0):
        score = {i: min(max(sum(map(int.__mul__, kept[a][0], v)), -(2**63)), 2**63 - 1) for i, (v, _) in kept.items() if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if kept[i][1] == kept[a][1]][:5]:
            fit = [i for i in ranked if kept[i][1] != kept[a][1] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            found += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(fit[:3], 1)]
    return sorted(found)


@pytest.mark.parametrize("n, width, scale", [(400, 6, 1.0), (120, 3, 4e7), (90, 4, 1e30)])
def test_hard_negatives(spark, monkeypatch, n, width, scale):
    """Blocks and chunks far smaller than the table, so that bounds have blocks to choose from."""
    for name, value in (("ROWS", 16), ("ANCHORS", 4), ("TOGETHER", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vector_rows(n, width, scale=scale)
    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
        *[T.StructField(c, T.StringType()) for c in NAMES],
    ])
    table = spark.createDataFrame([Row(*r, *["x"] * len(NAMES)) for r in rows], schema)
    got = mine_hard_negatives(table, lambda i: i % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, width)


def test_hard_negatives_broadcast_nothing(spark, monkeypatch):
    """What is read is many rows in few bytes of Parquet: chosen by those bytes, it would all go to the driver.

    Labels follow the vectors, so that an anchor's own block has no negatives and gives no cutoff.
    """
    for name, value in (("ROWS", 16), ("ANCHORS", 4), ("TOGETHER", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    plans, written = [], hard_negatives.stage
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(hard_negatives, "stage", lambda df, name: plan(df) or written(df, name))
    rng = np.random.default_rng(3)
    centres = 300 * (2 + rng.standard_normal((5, 4)))
    rows = [(i, (centres[i % 5] + rng.standard_normal(4)).astype(np.float32).tolist(), i % 5) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = mine_hard_negatives(table, lambda i: i % 50 == 0)
    plan(got)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, 4) != []
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastExchange" in p for p in plans)


@pytest.mark.parametrize("most, kind", [(2**15 - 1, "<i2"), (2**15, "<i4"), (2**31 - 1, "<i4"), (2**31, "<f8"), (1e300, "<f8")])
def test_packed_vectors(spark, most, kind):
    rows = [[0.0, -float(most), 1.0], [float(most)], []]
    packing = hard_negatives.Packing.of(spark.createDataFrame([(r,) for r in rows], "vec array<double>"))
    plain = np.array([r + [0.0] * (3 - len(r)) for r in rows])
    packed = packing.pack(plain)
    assert packing == (3, kind) and (packing.matrix(packed) == plain).all() and (packing.matrix(packed[1:]) == plain[1:]).all()


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert mine_hard_negatives(empty, lambda i: i % 50 == 0).count() == 0
    assert windows_of(-7, 50, 95) == (-3, -7) and windows_of(7, 50, 95) == (4, 6) and windows_of(0, 50, 95) == (0, 0)


ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_in(text):
    return ITEM_WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def plain_passages(rows, items, length):
    windows = {}
    for item, text in items:
        words = words_in(text)
        size = min(len(words), length)
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    found = []
    for i, text in rows:
        words, hits, named = words_in(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                known = windows.get(tuple(words[at : at + size]))
                if known is not None:
                    hits |= set(range(at, at + size))
                    named |= known - {None}
        found.append((i, len(words), sorted(hits), sorted(named)))
    return sorted(found, key=repr)


def contaminated_rows():
    rows = edge_rows()
    words = words_in(rows[5][1])
    items = [("i1", " ".join(words[3:20])), ("i10", " ".join(words[10:20])), ("i2", "ONE  two!"), ("i3", ""), ("i4", None), (None, "gamma, gamma")]
    items += [("i5", "日本語 テスト"), ("i2", "one two"), ("i6", "never there at all")]
    third = [(5000 + i, f"Start {i}: " + ", ".join(words[3:14]) + " END.") for i in range(30)]
    return rows + third, items


@pytest.mark.parametrize("broadcast_bytes", [32 << 20, 300])
def test_passages(spark, broadcast_bytes):
    rows, items = contaminated_rows()
    bench = spark.createDataFrame([(*x, "x", "x") for x in items], "item_id string, text string, words string, hash string")
    got = find_passages(frame(spark, rows), bench, broadcast_bytes=broadcast_bytes).collect()
    assert sorted(((r.id, r.n_words, r.hits, r["items"]) for r in got), key=repr) == plain_passages(rows, items, 10)
    assert find_passages(frame(spark, []), bench).count() == 0
    none = find_passages(frame(spark, rows), bench.limit(0))
    assert none.filter(F.size("hits") > 0).isEmpty() and none.count() == len(rows)


def test_passages_go(spark):
    item = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([("a", item)], "item_id string, text string")
    rows = [(1, "Start here. " + item.upper() + "! And on."), (2, item), (3, "clean text"), (4, None), (5, item + " and many more words that follow on it")]
    docs = frame(spark, rows)
    got = {r.doc_id: r.text for r in decontaminate(docs, bench).collect()}
    assert got == {1: "Start here! And on.", 2: "", 3: "clean text", 4: None, 5: " and many more words that follow on it"}
    assert {r.doc_id for r in decontaminate(docs, bench, drop_share=0.6).collect()} == {3, 4, 5}
    assert decontaminate(docs, bench).schema.names == SCHEMA.names


def test_decontamination_is_native(spark):
    rows, items = contaminated_rows()
    bench = spark.createDataFrame(items, "item_id string, text string")
    bench.write.mode("overwrite").format("noop").save()
    plan = find_passages(frame(spark, rows), bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoopJoin|SinglePartition", plan)
