"""A training corpus from raw documents: reject bad ones, drop shared lines, keep one of each group of near copies,
mask personal data, and pack what is left into sequences.

Each stage takes the whole of what the one before has kept. All but the last return the columns of ``documents``, in
their order; where a text changes, ``n_chars`` follows it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.llm.line_dedup import dedup_lines
from docloom.llm.ngram_join import linked, text_key
from docloom.llm.packing import pack
from docloom.llm.pii import mask_pii
from docloom.llm.quality import score_quality, train_quality
from docloom.llm.queries import vocabulary
from docloom.llm.shared import table
from docloom.session import stage

KEEP = 0.7


def _like(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the length of the text as it is now."""
    return changed.select(
        *[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network scores 0.7 or more."""
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, score_col="_score").filter(F.col("_score") >= KEEP).select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 10 characters stay only in the smallest document that holds them."""
    return _like(dedup_lines(docs), docs)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that five-word runs link at a similarity of 0.8, one row: the one of smallest id.

    Rows without an id come last, and of several rows of that id the one with the smallest text hash stays. Rows that
    link with nothing stay all, also where they share an id or have none, and so do rows without words.
    """
    own = ["doc", "k1", "k2"]
    texts = linked(docs, n=5, percent=80, id_col="doc_id", text_col="text").groupBy(*own).agg(
        F.any_value("comp").alias("comp"), F.count(F.lit(1)).alias("copies")
    )
    texts = stage(texts, "texts")
    foremost = F.struct(F.col("doc").isNull().alias("last"), *own, "copies")
    first = texts.filter("comp is not null").groupBy("comp").agg(F.min(foremost).alias("f")).select("f.doc", "f.k1", "f.k2", "f.copies")
    kept = first.union(texts.filter("comp is null").select(*own, F.lit(1).alias("copies"))).toDF("_doc", "_k1", "_k2", "_copies")
    same = [F.col("doc_id").cast("long").eqNullSafe(F.col("_doc"))] + [k == F.col(c) for k, c in zip(text_key("text"), ("_k1", "_k2"))]
    one, several = (docs.join(kept.filter(f), same, "left_semi") for f in ("_copies = 1", "_copies > 1"))
    # Rows of one id and text: only these are grouped, and combined before they are exchanged.
    row = F.struct(*docs.columns)
    combined = several.groupBy("doc_id", *text_key("text")).agg(F.any_value(row).alias("_row"))
    return one.union(combined.select(*[F.col("_row")[c].alias(c) for c in docs.columns]))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every confirmed span of personal data becomes the name of its kind."""
    return _like(mask_pii(docs), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of each document with its place in a sequence of 1024 tokens."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), capacity=1024, end_id=2)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("line_dedup", drop_shared_lines),
    ("near_duplicates", keep_first_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# A trained network and connected components cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written once and read by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
