"""Registered queries against their SQL, the pipeline against plain computations, and what must stay out of plans."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docloom.llm.pii import BASE
from docloom.llm.queries import llm_oracles, llm_queries, op4_pii, op9_sharding
from tests.llm.helpers import edge_rows
from tests.llm.test_corpus_operators import plain_join
from tests.llm.test_text_operators import PII_TEXTS, PLAIN, confirmed, plain_line_dedup
from tests.test_queries import canonical

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    rows = llm_queries()[name](spark, SF_DIR)
    cursor = duck.execute(llm_oracles()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(rows.columns) == sorted(columns)
    assert canonical(rows.columns, [tuple(r) for r in rows.collect()]) == canonical(columns, cursor.fetchall())


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """A folder with a documents table of awkward rows, ids made different for SQL."""
    texts = [t for _, t in edge_rows()] + PII_TEXTS
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("awkward"))
    spark.createDataFrame(rows, DOCUMENTS).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


@pytest.mark.parametrize("name", ["op3_line_dedup", "op4_pii"])
def test_awkward_rows_match_sql(spark, awkward, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{awkward[0]}/documents.parquet/*.parquet'")
    cursor = duck.execute(llm_oracles()[name])
    rows = llm_queries()[name](spark, awkward[0])
    assert canonical(rows.columns, [tuple(r) for r in rows.collect()]) == canonical([c[0] for c in cursor.description], cursor.fetchall())


def test_each_stage_does_its_work(spark, awkward):
    folder, rows = awkward
    docs = spark.createDataFrame(rows, DOCUMENTS)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_duplicates", "pii", "packing"]

    def texts(frame):
        assert frame.columns == docs.columns
        found = frame.collect()
        assert all(r.n_chars in (len(r.text or ""), None) for r in found)
        return sorted(((r.doc_id, r.text) for r in found), key=repr)

    pairs = sorted(((r[0], r[1]) for r in rows), key=repr)
    assert texts(stages["quality"](spark, docs, folder)) == pairs  # no labels: all stay
    assert texts(stages["line_dedup"](spark, docs, folder)) == sorted(((i, t) for i, t, *_ in plain_line_dedup(pairs)), key=repr)
    first = {i for i, _, c in plain_join(pairs, 5, 80) if i == c}
    assert texts(stages["near_duplicates"](spark, docs, folder)) == [p for p in pairs if p[0] in first]
    masked = dict(texts(stages["pii"](spark, docs, folder)))
    for i, text in pairs:
        text = text or ""
        for kind in BASE:
            text = re.sub(PLAIN[kind.name], lambda m, k=kind.name: f"<{k.upper()}>" if confirmed(k, m.group()) else m.group(), text)
        assert masked[i] == text
    packed = stages["packing"](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == len(pairs)


def test_repeated_ids_leave_one_row(spark, awkward):
    rows = [(1, "a b c d e f g", "en", "s", 13)] * 3 + [(None, "q w e r t y", "en", "s", 11)] * 2 + [(2, None, "en", "s", None)]
    kept = corpus_pipeline.keep_first_copies(spark, spark.createDataFrame(rows, DOCUMENTS), awkward[0]).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == [1, 2, None]


def test_rows_that_are_no_copies_all_stay(spark, awkward):
    """Different texts without an id and under one id, beside copies of each kind."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, text(k)) for k in range(5)] + [(7, text(k)) for k in range(5, 8)] + [(None, text(0)), (3, text(1) + " z"), (7, text(5) + " z")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCUMENTS)
    kept = corpus_pipeline.keep_first_copies(spark, docs, awkward[0]).collect()
    got = [(r.doc_id, min(k for k in range(8) if text(k) in r.text)) for r in kept]
    assert sorted(got, key=repr) == sorted([(None, 0), (3, 1), *[(None, k) for k in (2, 3, 4)], (7, 5), (7, 6), (7, 7)], key=repr)


def test_pipeline_runs_and_rejects_bad_documents(spark):
    folder = "/root/testdata/sf0.01"
    packed = corpus_pipeline.run(spark, folder)
    left = packed.select("doc_id").distinct()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    shares = labels.join(left, "doc_id", "left_semi").groupBy("quality").count().collect()
    kept = {r.quality: r["count"] for r in shares}
    every = {r.quality: r["count"] for r in labels.groupBy("quality").count().collect()}
    assert kept.get(0, 0) <= 0.05 * every[0] and kept[1] >= 0.6 * every[1]


def test_native_operators_run_no_python_and_nothing_is_crossed(spark):
    for query in (llm_queries()["op3_line_dedup"], op4_pii, op9_sharding):
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
            assert operator not in plan
        assert query is op9_sharding or not re.search("Python|Arrow|Pandas", plan)


def test_one_key_in_a_third_of_all_rows(spark):
    """A line, and a text, that a third of all documents share."""
    shared = F.when(F.col("id") % 3 == 0, "a line that very many share")
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.coalesce(shared, F.concat(F.lit("own words of number "), F.col("id").cast("string"))).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(None).cast("long").alias("n_chars"),
    )
    kept = corpus_pipeline.drop_shared_lines(spark, docs, SF_DIR)
    assert kept.filter("text = ''").count() == 1999
    assert corpus_pipeline.keep_first_copies(spark, docs, SF_DIR).count() == 4001
