"""Documents whose sets of word n-grams have a Jaccard similarity of at least a threshold, by a grouped prefix join.

Every set has a prefix, in one order of all n-grams, such that similar sets share an n-gram of their prefixes. Documents
with the same set are one class; classes with the same prefix and size are one group. Groups meet on the n-grams of
their prefixes, pairs are filtered by size and by a sketch, and the members of what is left are compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.components import components
from docloom.llm.shared import SPACE, UPPER
from docloom.llm.words import run_hashes, small_batches
from docloom.session import stage

# Bits of a sketch; rounds that compare each document with one other; n-grams that come last in the order, at most;
# n-grams counted together, and the part of their documents from which on one counts as frequent.
BITS, STARS, FREQUENT, CHUNK, PART = 1024, 2, 100_000, 1 << 21, 1000
PART_BYTES = 1 << 20
# Sets of more n-grams than this also get a wide sketch, of at least as many bits as they have n-grams.
LARGE = 2048

_lower = np.arange(256, dtype=np.uint8)
_lower[[ord(c) for c in UPPER]] += 32
_blank = np.zeros(256, dtype=bool)
_blank[[ord(c) for c in SPACE]] = True


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _parts(data: bytes) -> Iterator[bytes]:
    """A text in parts of a few megabytes, cut at white space."""
    start = 0
    while len(data) - start > PART_BYTES:
        end = start + PART_BYTES
        while end < len(data) and not _blank[data[end]]:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of the words of each text, lower case for A-Z only."""

    def together(group: list[bytes]) -> list[np.ndarray]:
        data = _lower[np.frombuffer(b" ".join([*group, b""]), dtype=np.uint8)]
        edge = np.diff(np.concatenate([[True], _blank[data], [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        hashes = run_hashes(data, starts, ends)
        limits = np.searchsorted(starts, np.cumsum([0, *[len(t) + 1 for t in group]]))
        return [hashes[a:b] for a, b in zip(limits[:-1].tolist(), limits[1:].tolist())]

    found: list[np.ndarray] = []
    group, size = [], 0
    for text in texts:
        if len(text) > PART_BYTES:
            if group:
                found += together(group)
                group, size = [], 0
            found.append(np.concatenate([together([part])[0] for part in _parts(text)]))
            continue
        group.append(text)
        size += len(text)
        if size > PART_BYTES // 2:
            found += together(group)
            group, size = [], 0
    return found + together(group) if group else found


def ngram_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words; fewer words make one run, none make none."""
    if not len(words):
        return words
    size = min(n, len(words))
    runs = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        runs = _mix(runs + words[i : i + len(runs)], i + 1)
    return np.unique(runs)


def ngram_sets(batch_texts: list, n: int) -> list[np.ndarray]:
    return [ngram_set(words, n) for words in word_hashes([b"" if t is None else t for t in batch_texts])]


def prefix_length(size: int, percent: int) -> int:
    return size + (-percent * size) // 100 + 1 if size else 0


def text_key(text: str) -> list[Column]:
    """128 bits of hash of a text column, the same for equal texts: ``k1`` and ``k2``."""
    data = F.col(text).cast("binary")
    return [F.xxhash64(data).alias("k1"), F.xxhash64(F.lit(1), data).alias("k2")]


def frequent_ngrams(rows: DataFrame, n: int) -> np.ndarray:
    """N-grams of a fixed part of all documents, most frequent last; ``rows`` has the text as binary in second place.

    An n-gram that a thousandth of all documents hold is in a thousandth of the documents of some chunk, so counting
    within chunks finds it. At most ``FREQUENT`` reach the driver. The list only sets the order in which n-grams make
    prefixes: what is similar does not depend on it.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = counts >= max(3, len(sets) // PART)
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["ngram", "docs"]
            )

        for batch in small_batches(batches):
            for found in ngram_sets(batch.column(1).to_pylist(), n):
                sets.append(found)
                size += len(found)
                if size > CHUNK:
                    yield flush()
                    sets, size = [], 0
        if sets:
            yield flush()

    most = (
        rows.mapInArrow(counted, "ngram long, docs long").groupBy("ngram").agg(F.sum("docs").alias("docs"))
        .orderBy(F.desc("docs"), "ngram").limit(FREQUENT)
    )
    found = most.toArrow().column("ngram").to_numpy().view(np.uint64)
    return found[::-1].copy()


def signatures(rows: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """For each row: id, text key, set size, 128 bits of set hash, prefix, and sketches of the set.

    A sketch holds the parities of hash buckets: ``BITS`` of them, and for large sets a second one of as many as the
    set has n-grams, at least.
    """
    order = np.argsort(frequent)
    known, place = frequent[order], order

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, marks, prefixes, sketches, wide = [], [], [], [], []
            for found in ngram_sets(batch.column(1).to_pylist(), n):
                sizes.append(len(found))
                marks.append((int(_mix(found, 11).sum(dtype=np.uint64)), int(_mix(found, 12).sum(dtype=np.uint64))))
                length = prefix_length(len(found), percent)
                if len(known) and length:
                    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    often = known[at] == found
                    rare = found[~often]
                    late = found[often][np.argsort(place[at[often]], kind="stable")] if length > len(rare) else rare[:0]
                    prefixes.append(np.concatenate([rare[:length], late[: max(0, length - len(rare))]]))
                else:
                    prefixes.append(found[:length])
                bucket = _mix(found, 13)
                sketches.append(_parities(bucket, BITS).view(np.int64))
                wide.append(_parities(bucket, 1 << (len(found) - 1).bit_length()).tobytes() if len(found) > LARGE else None)
            if not sizes:
                continue
            ends = pa.array(np.cumsum([0, *map(len, prefixes)]).astype(np.int32))
            words = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * (BITS // 64))
            both = np.array(marks, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), batch.column(3), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(prefixes).view(np.int64))),
                    pa.ListArray.from_arrays(words, pa.array(np.concatenate(sketches))), pa.array(wide, pa.binary()),
                ],
                names=["doc", "k1", "k2", "n", "h1", "h2", "prefix", "sketch", "wide"],
            )

    return rows.mapInArrow(
        signed, "doc long, k1 long, k2 long, n long, h1 long, h2 long, prefix array<long>, sketch array<long>, wide binary"
    )


def _parities(bucket: np.ndarray, bits: int) -> np.ndarray:
    counts = np.bincount((bucket % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8))


def _wide_apart(one: bytes, other: bytes) -> int:
    """At most the size of the symmetric difference; the longer sketch is folded to the length of the shorter one."""
    a, b = np.frombuffer(one, dtype=np.uint8), np.frombuffer(other, dtype=np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _enough_left(rest_a: Column, rest_b: Column, both: Column, percent: int) -> Column:
    """Whether sets that first meet here, with so many n-grams from here on, can overlap as much as they must.

    Similarity t needs an overlap of t / (1 + t) of the two sizes together.
    """
    return (100 + percent) * F.least(rest_a, rest_b) >= percent * both


def _apart(a: Column, b: Column) -> Column:
    """At most the size of the symmetric difference of two sets, from their sketches."""
    bits = F.lit(0)
    for i in range(BITS // 64):
        bits = bits + F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return bits


def _close(pairs: DataFrame, nodes: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that size and sketches do not rule out, with ``apart``.

    Similarity t allows a symmetric difference of (1 - t) / (1 + t) of the two sizes together.
    """
    side = nodes.select("node", "n", "sketch")
    joined = pairs.join(side.toDF("a", "n_a", "sketch_a"), "a").join(side.toDF("b", "n_b", "sketch_b"), "b")
    apart = joined.filter(_sizes_fit(F.col("n_a"), F.col("n_b"), percent)).select(
        "a", "b", _apart(F.col("sketch_a"), F.col("sketch_b")).cast("long").alias("apart"),
        ((100 - percent) * (F.col("n_a") + F.col("n_b"))).alias("room"), (F.least("n_a", "n_b") > LARGE).alias("large"),
    )
    near = stage(apart.filter((100 + percent) * F.col("apart") <= F.col("room")), "near")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            one, other, room = (batch.column(i).to_pylist() for i in (3, 4, 2))
            apart = [_wide_apart(x, y) for x, y in zip(one, other)]
            keep = pa.array([(100 + percent) * n <= most for n, most in zip(apart, room)], pa.bool_())
            columns = [batch.column(0), batch.column(1), pa.array(apart, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "apart"]).filter(keep)

    large = (
        near.filter("large").join(wide.toDF("a", "wide_a"), "a").join(wide.toDF("b", "wide_b"), "b")
        .select("a", "b", "room", "wide_a", "wide_b").mapInArrow(compared, "a long, b long, apart long")
    )
    return near.filter("not large").select("a", "b", "apart").union(large)


def _verified(pairs: DataFrame, rows: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, compared element by element.

    ``texts`` has the key of one text of each node; however many rows hold that text, one of them is read.
    """
    pairs = stage(pairs.select("a", "b"), "candidates")
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    chosen = texts.join(ids, "node")
    one_each = rows.join(chosen, ["k1", "k2"]).groupBy("node").agg(F.any_value("t").alias("t"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = ngram_sets(batch.column(1).to_pylist(), n)
            if sets:
                ends = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
                values = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, values)], names=["node", "grams"])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, other = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                shared = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * shared >= percent * (len(one) + len(other) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    sets = stage(one_each.mapInArrow(made, "node long, grams array<long>"), "sets")
    joined = pairs.join(sets.toDF("b", "grams_b"), "b").join(sets.toDF("a", "grams_a"), "a")
    return stage(joined.select("a", "b", "grams_a", "grams_b").mapInArrow(similar, "a long, b long").distinct(), "links")


def _star_pairs(postings: DataFrame, percent: int, central: bool) -> DataFrame:
    """For each posting, pairs (a, b) of two ends of its n-gram, a, and its own group, b, if of another component.

    The ends are the groups of the first and the last component. ``central`` takes the group with the fewest rarer
    n-grams in place of the first one: of near copies of one text that is the text, or the copy least changed, which is
    similar to more of them than they are to each other. Pairs are as many as the postings, twice at most, whatever the
    number of groups that share an n-gram.
    """
    group = F.struct("comp", "gid", "n")
    first = F.min_by(group, F.struct("pos", "comp", "gid")) if central else F.min(group)
    ends = stage(
        postings.groupBy("ngram").agg(first.alias("one"), F.max(group).alias("other"), F.min("comp").alias("low"))
        .filter(F.col("low") < F.col("other.comp")).select("ngram", "one", "other"),
        "ends",
    )
    both = F.explode(F.array("one", "other")).alias("end")
    return (
        postings.join(ends, "ngram").select("gid", "comp", "n", both)
        .filter((F.col("comp") != F.col("end.comp")) & _sizes_fit(F.col("n"), F.col("end.n"), percent))
        .select(F.col("end.gid").alias("a"), F.col("gid").alias("b")).distinct()
    )


def _cross_pairs(postings: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """All pairs of documents of different components that share an n-gram of their prefixes and fit in size.

    Components meet first, so that no pairs are made inside of a component, however many groups it has. Two sets are
    only paired at an n-gram after which enough of both is left; the first one that they share is such a one.
    """
    mixed = stage(
        postings.groupBy("ngram").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        .filter("low < high").select("ngram"),
        "mixed",
    )
    units = stage(postings.join(mixed, "ngram"), "units")
    spans = stage(units.groupBy("ngram", "comp").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("pos")), "spans")
    met = (
        spans.toDF("ngram", "comp_a", "least_a", "most_a", "pos_a")
        .join(spans.toDF("ngram", "comp_b", "least_b", "most_b", "pos_b"), "ngram")
        .filter(
            (F.col("comp_a") < F.col("comp_b")) & (100 * F.col("most_a") >= percent * F.col("least_b"))
            & (100 * F.col("most_b") >= percent * F.col("least_a"))
            & _enough_left(
                F.col("most_a") - F.col("pos_a"), F.col("most_b") - F.col("pos_b"), F.col("least_a") + F.col("least_b"), percent
            )
        )
        .select("ngram", "comp_a", "comp_b")
    )
    own = units.select("ngram", "comp", "gid", "n", "pos")
    groups = (
        met.join(own.toDF("ngram", "comp_a", "gid_a", "n_a", "pos_a"), ["ngram", "comp_a"])
        .join(own.toDF("ngram", "comp_b", "gid_b", "n_b", "pos_b"), ["ngram", "comp_b"])
        .filter(
            _sizes_fit(F.col("n_a"), F.col("n_b"), percent)
            & _enough_left(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"), F.col("n_a") + F.col("n_b"), percent)
        )
        .select("gid_a", "comp_a", "gid_b", "comp_b").distinct()
    )
    members = nodes.select("gid", "comp", "node")
    return (
        groups.join(members.toDF("gid_a", "comp_a", "a"), ["gid_a", "comp_a"])
        .join(members.toDF("gid_b", "comp_b", "b"), ["gid_b", "comp_b"])
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def linked(documents: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row for each document: ``doc`` (its id), ``k1``, ``k2`` (``text_key``), ``n`` (set size), ``comp`` and ``name``.

    ``comp`` is a number that documents of one component share, null for empty sets; ``name`` is the smallest id in it.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("binary").alias("t"), *text_key(text_col))
    frequent = frequent_ngrams(rows, n)
    found = signatures(rows, n, percent, frequent)
    signed = stage(found.withColumns({"p1": F.xxhash64("prefix"), "p2": F.xxhash64(F.lit(1), "prefix")}), "signatures")
    # A class is a node of its own number, so that neither rows without an id nor equal ids make one of two classes.
    classes = signed.filter("n > 0").groupBy("n", "h1", "h2").agg(
        F.min("doc").alias("doc"), F.min(F.struct("k1", "k2")).alias("key"),
        *[F.any_value(c).alias(c) for c in ("p1", "p2", "prefix", "sketch", "wide")]
    )
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    groups = stage(
        classes.groupBy("n", "p1", "p2").agg(
            F.min("node").alias("gid"), F.any_value("prefix").alias("prefix"), F.least(F.count(F.lit(1)), F.lit(2)).alias("members")
        ),
        "groups",
    )
    keyed = stage(classes.join(groups.select("n", "p1", "p2", "gid"), ["n", "p1", "p2"]).drop("p1", "p2", "prefix"), "keyed")
    nodes = keyed.select("node", "gid", "n", "sketch")
    wide = keyed.filter("wide is not null").select("node", "wide")
    texts = keyed.select("node", "key.k1", "key.k2")
    # Only n-grams that several classes share can join any.
    several = stage(
        groups.select(F.explode("prefix").alias("ngram"), "members").groupBy("ngram").agg(F.sum("members").alias("k"))
        .filter("k > 1").select("ngram"),
        "several",
    )
    placed = groups.select(F.posexplode("prefix").alias("pos", "ngram"), "gid", "n")
    postings = stage(placed.join(several, "ngram").select("ngram", "gid", "n", "pos"), "postings")

    # Members of a group meet its first one.
    inside = nodes.filter("node <> gid").select(F.col("gid").alias("a"), F.col("node").alias("b"))
    labelled = nodes.withColumn("comp", F.col("node"))
    links: DataFrame | None = None

    def unit_postings() -> DataFrame:
        if links is None:
            return postings.withColumn("comp", F.col("gid"))
        return postings.join(labelled.select("gid", "comp").distinct(), "gid").select("ngram", "gid", "n", "pos", "comp")

    for number in range(STARS + 1):
        units = unit_postings()
        if number < STARS:
            pairs = _star_pairs(units, percent, central=number == 0)
            pairs = _close(pairs.union(inside) if number == 0 else pairs, nodes, wide, percent)
            pairs = pairs.groupBy("b").agg(F.min_by("a", F.struct("apart", "a")).alias("a")).select("a", "b")
        else:
            pairs = _close(_cross_pairs(units, labelled, percent), nodes, wide, percent)
        found = _verified(pairs, rows, texts, n, percent)
        links = found if links is None else links.union(found)
        label = components(links)
        labelled = stage(
            nodes.join(label, "node", "left").select("node", "gid", "n", "sketch", F.coalesce("comp", "node").alias("comp")),
            "labelled",
        )
    of_class = stage(keyed.select("n", "h1", "h2", "node", "doc").join(labelled.select("node", "comp"), "node"), "named")
    names = of_class.groupBy("comp").agg(F.min("doc").alias("name"))
    by_class = of_class.join(names, "comp").select("n", "h1", "h2", "comp", "name")
    return signed.select("doc", "k1", "k2", "n", "h1", "h2").join(by_class, ["n", "h1", "h2"], "left").drop("h1", "h2")


def ngram_join(
    documents: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each document: its id, ``n_shingles`` (set size) and ``component_id``.

    Two documents link if 100 * |intersection| >= ``percent`` * |union| of their sets of ``n``-word runs; documents
    with fewer words have one run of all their words. A component is named by its smallest id. Null and empty texts and
    texts without words have empty sets and link with nothing: they are named by their own id. Every row is a document
    of its own, also without an id or with the id of another row, and links by its own text only; a component without
    any id is named by null. Repeated rows are returned as often as they stand. Other columns are not read. An empty
    table gives no rows.

    Documents with equal sets are one class from the start. Rounds of linear size compare each class with one other
    that shares an n-gram; only then do components, not documents, meet on n-grams, so a group of near copies makes no
    pairs beyond its first links. The sets of classes that are compared are the only ones written.
    """
    own_if_empty = F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc"))
    return linked(documents, n, percent, id_col, text_col).select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), own_if_empty.alias("component_id")
    )
