"""Passages of a benchmark found in, and removed from, training documents, with DataFrame functions only.

The benchmark's windows of normalised words are a broadcast hash set; every window of every document is looked up in
it and, where the hash is found, held against the words themselves. What is found is put together by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.shared import ascii_lower, let, text_of
from docloom.session import stage

# What stands between words, in lower-cased and in original texts.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_CASED, WORD_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Most bytes of windows that are broadcast at once; a larger benchmark is looked up in several parts.
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BETWEEN), "")


def _places(words: Column, size: Column) -> Column:
    """Places of the runs of ``size`` words."""
    last = F.size(words) - size
    return F.when((last >= 0) & (size > 0), F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _run(place: Column, size: Column) -> Column:
    """Words of one run. Compiled, this costs the run's length; inside a lambda function it would copy the whole text."""
    return F.slice("words", F.greatest(place, F.lit(0)) + 1, size)


def benchmark_windows(benchmark: DataFrame, length: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Each different window once: ``window`` (its words joined by spaces), ``size`` in words, ``hash`` and ``items``.

    Items of fewer than ``length`` words are one window; those without words, with null or empty text, have none. Rows
    without an id give windows that name no item; rows of one id count as one item.
    """
    items = benchmark.select(F.col(item_col).alias("item"), words_of(text_of(text_col)).alias("words"))
    sized = items.select("item", "words", F.least(F.size("words"), F.lit(length)).alias("size"))
    placed = sized.select("*", F.explode(_places(F.col("words"), F.col("size"))).alias("place"))
    runs = placed.select("item", "size", _run(F.col("place"), F.col("size")).alias("run"))
    return runs.groupBy("size", F.array_join("run", " ").alias("window")).agg(
        F.any_value(F.xxhash64("run")).alias("hash"), F.sort_array(F.collect_set("item")).alias("items")
    )


def _looked_up(texts: DataFrame, windows: DataFrame, sizes: list[int], first: bool) -> DataFrame:
    """Windows of the texts that are in ``windows``, and in the first part a row of place -1 for each text."""

    def of_size(size: int) -> Column:
        return F.transform(_places(F.col("words"), F.lit(size)), lambda i: F.struct(i.alias("place"), F.lit(size).alias("size")))

    whole = F.array(F.struct(F.lit(-1).alias("place"), F.lit(0).alias("size")))
    exploded = texts.select("*", F.inline(F.concat(*[whole] * first, *[of_size(size) for size in sizes])))
    run = _run(F.col("place"), F.col("size"))
    hashed = exploded.withColumn("hash", F.when(F.col("place") >= 0, F.xxhash64(run)))
    known = F.broadcast(windows.select(F.col("hash").alias("known"), "window", "items"))
    # The words are compared after the join: as a join key, they would be put together for every window of every text.
    joined = hashed.join(known, F.col("hash") == F.col("known"), "left" if first else "inner")
    return joined.filter((F.col("place") < 0) | (F.array_join(run, " ") == F.col("window"))).select(
        "id", "text_key", F.size("words").alias("n_words"), "place", "size", "items"
    )


def find_passages(
    documents: DataFrame, benchmark: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """For each document: ``id``, ``text_key`` (SHA-256 of its text), ``n_words``, ``hits`` and ``items``.

    ``hits`` are the places (from 0, in order) of all words inside any occurrence of a window of ``length`` consecutive
    words of an item; ``items`` the sorted ids of items with such windows. Null and empty texts have no words. Rows that
    are the same in id and text each give their row, with equal results; rows without an id are kept. An empty table of
    documents gives no rows, and with an empty benchmark nothing is hit. Other columns do not matter.

    Only windows that are hit and one row for each document are shuffled. The windows of the benchmark are broadcast in
    parts of about ``broadcast_bytes`` each, by a hash of the window; with more than one part the documents are read
    for each of them, with the same result.
    """
    windows = stage(benchmark_windows(benchmark, length, item_col, item_text_col), "benchmark-windows")
    weight = F.octet_length("window") + 8 * F.size("items") + 64
    total, sizes = windows.agg(F.sum(weight), F.collect_set("size")).first()
    parts = max(1, -(-(total or 0) // broadcast_bytes))
    texts = documents.select(
        F.col(id_col).alias("id"), F.sha2(text_of(text_col).cast("binary"), 256).alias("text_key"),
        words_of(text_of(text_col)).alias("words"),
    )
    found = None
    for part in range(parts):
        some = windows.filter(F.pmod("hash", F.lit(parts)) == part) if parts > 1 else windows
        rows = _looked_up(texts, some, sorted(sizes), first=part == 0)
        found = rows if found is None else found.union(rows)
    grouped = found.groupBy("id", "text_key", "n_words").agg(
        F.count(F.when(F.col("place") < 0, 1)).alias("rows"),
        F.collect_set(F.when(F.col("place") >= 0, F.struct("place", "size"))).alias("runs"),
        F.collect_set("items").alias("items"),
    )
    places = F.flatten(F.transform("runs", lambda r: F.sequence(r["place"], r["place"] + r["size"] - 1)))
    return grouped.select(
        "id", "text_key", "n_words", F.sort_array(F.array_distinct(places)).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"),
        F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("row"),
    ).drop("row")


def _without(text: Column, hits: Column) -> Column:
    """The text less the words at ``hits``, each with what stands between it and the word before."""
    words, gaps = F.array_remove(F.split(text, BETWEEN_CASED), ""), F.split(text, WORD_CASED, -1)
    last = F.size(hits) - 1
    begins = F.filter(hits, lambda x, i: (i == 0) | (F.get(hits, i - 1) != x - 1))
    ends = F.filter(hits, lambda x, i: (i == last) | (F.get(hits, i + 1) != x + 1))

    def kept(chunks: Column) -> Column:
        """``chunks`` are the words, each after its gap, and the last gap; runs of hits go."""
        froms = F.concat(F.array(F.lit(0)), F.transform(ends, lambda e: e + 1))
        tos = F.concat(begins, F.array(F.size(chunks)))
        return F.array_join(F.flatten(F.zip_with(froms, tos, lambda a, b: F.slice(chunks, a + 1, b - a))), "")

    chunks = let(words, lambda w: let(gaps, lambda g: F.zip_with(g, w, lambda gap, word: F.concat(gap, F.coalesce(word, F.lit(""))))))
    return let(chunks, kept)


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, length: int = 10, drop_share: float | None = None,
    id_col: str = "doc_id", text_col: str = "text", **named,
) -> DataFrame:
    """``documents`` with their own columns, less the passages of the benchmark.

    Hit words go from the text with what stands before them. With ``drop_share``, documents with at least that share
    of their words hit go as a whole instead. Null texts stay null; rows that are not hit stay as they are. Columns may
    have any names. Only hit texts are joined, by the hash of the text, so a copy of a hit text is mended once found.
    """
    found = find_passages(documents, benchmark, length, id_col, text_col, **named).filter(F.size("hits") > 0)
    hit = found.groupBy(F.col("text_key").alias("__hit_key")).agg(
        F.any_value("hits").alias("__hits"), F.any_value("n_words").alias("__hit_words")
    )
    joined = documents.join(hit, F.sha2(text_of(text_col).cast("binary"), 256) == F.col("__hit_key"), "left")
    if drop_share is not None:
        joined = joined.filter(F.coalesce(F.size("__hits") < drop_share * F.col("__hit_words"), F.lit(True)))
    mended = F.when(F.col("__hits").isNull(), F.col(text_col)).otherwise(_without(F.col(text_col), F.col("__hits")))
    return joined.select(*[mended.alias(c) if c == text_col else F.col(c) for c in documents.columns])
