"""How filters of a corpus overlap, in every order of applying them; repeated texts are found with radix tries.

Every task inserts its texts into compressed tries, so that each text leaves it once. These texts are partitioned into
ranges that share a prefix, with longer prefixes where a range is too large, and inserted into one trie for each range.
Terminals hold the smallest id; walking back over them gives every document its flag. Masks of flags are then reduced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.shared import UPPER, blocks_of, let, text_of
from docloom.session import stage

# Characters that one task's trie holds, and bytes of text a range may have before its prefix grows.
TRIE_CHARS, RANGE_BYTES = 4 << 20, 8 << 20
# Characters of the shortest prefix, and the factor by which prefixes grow.
PREFIX, GROWTH = 8, 8
# Texts of one partition, in bytes.
PARTITION_BYTES = 32 << 20

Check = Callable[[Column], Column]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def few_words(least: int) -> Check:
    return lambda text: F.size(_words(text)) < least


def few_distinct_words(percent: int) -> Check:
    return lambda text: let(_words(text), lambda w: 100 * F.size(F.array_distinct(w)).cast("long") < percent * F.size(w).cast("long"))


def many_capitals(percent: int) -> Check:
    capitals = lambda text: F.length(text) - F.length(F.translate(text, UPPER, ""))
    return lambda text: 100 * capitals(text).cast("long") > percent * F.length(text).cast("long")


def holds_any(pattern: str) -> Check:
    return lambda text: text.rlike(pattern)


CHECKS: dict[str, Check] = {
    "A": few_words(50), "B": few_distinct_words(65), "C": many_capitals(5), "D": holds_any("[#$%&*|]"),
}
REPEATED = "E"


class RadixTrie:
    """A compressed trie of whole texts. ``place`` gives the number of the text's terminal; equal texts share one."""

    def __init__(self):
        self.root = ["", {}, None]
        self.size = 0

    def place(self, text: str) -> int:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = node[1][text[at]] = [text[at:], {}, None]
            label = child[0]
            if not text.startswith(label, at):
                both = _shared(label, text, at)
                # The edge is cut where the two texts part.
                upper = node[1][text[at]] = [label[:both], {label[both]: child}, None]
                child[0] = label[both:]
                child = upper
            at += len(child[0])
            node = child
        if node[2] is None:
            node[2] = self.size
            self.size += 1
        return node[2]


def _shared(label: str, text: str, at: int) -> int:
    """How many characters ``label`` has in common with ``text`` from ``at`` on."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


def _least(ids, places: list[int], size: int) -> list[int | None]:
    found: list[int | None] = [None] * size
    for number, place in zip(ids, places):
        if number is not None and (found[place] is None or number < found[place]):
            found[place] = number
    return found


LOCAL = pa.schema([
    ("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("entry", pa.int64()), ("least", pa.int64()), ("text", pa.string()),
])


def _local_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their text; only the first row of a text keeps it, with the smallest id in this trie."""
    start, base = TaskContext.get().partitionId() << 40, 0
    trie, rows, places, chars = RadixTrie(), [], [], 0

    def flush() -> pa.RecordBatch:
        least, seen, found = _least((r[0] for r in rows), places, trie.size), set(), []
        for row, place in zip(rows, places):
            first = place not in seen
            seen.add(place)
            found.append((*row[:3], start + base + place, least[place] if first else None, row[3] if first else None))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), LOCAL)], schema=LOCAL)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "mask", "text"))):
            places.append(trie.place(row[3]))
            rows.append(row)
            chars += len(row[3])
            if chars > TRIE_CHARS or len(rows) >= 20_000:
                yield flush()
                base += trie.size
                trie, rows, places, chars = RadixTrie(), [], [], 0
    if rows:
        yield flush()


MERGED = pa.schema([("entry", pa.int64()), ("top", pa.int64()), ("least", pa.int64()), ("text", pa.string())])


def _range_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts sorted by range: each entry with the first entry of its text (``top``) and the smallest id.

    The text stays only at a ``top`` of a salted range, whose parts are put together once more.
    """
    trie, entries, places, now = RadixTrie(), [], [], None

    def flush() -> pa.RecordBatch:
        least, tops, found = _least((e[1] for e in entries), places, trie.size), {}, []
        for (entry, _, text), place in zip(entries, places):
            top = tops.setdefault(place, entry)
            found.append((entry, top, least[place], text if top == entry else None))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), MERGED)], schema=MERGED)

    for batch in batches:
        for key, salt, entry, least, text in zip(*(batch.column(c).to_pylist() for c in ("key", "salt", "entry", "least", "text"))):
            if now != (key, salt) and entries:
                yield flush()
                trie, entries, places = RadixTrie(), [], []
            now = key, salt
            places.append(trie.place(text))
            # A repeated text is not held again.
            entries.append((entry, least, text if salt >= 0 and places[-1] == trie.size - 1 else None))
    if entries:
        yield flush()


def _ranged(texts: DataFrame, range_bytes: int) -> tuple[DataFrame, bool]:
    """``texts`` with the ``key`` of their range and a ``salt``: -1, or a part of a range that is one very frequent text.

    Where the texts of one prefix have more than ``range_bytes``, the prefix grows. Only hashes of such prefixes are
    broadcast: there are at most as many as ``range_bytes`` fits into all texts, 16 bytes each.
    """
    rows = texts.withColumns({"cut": F.lit(PREFIX), "salt": F.lit(-1)})
    cut, salted = PREFIX, False
    prefix = F.xxhash64("cut", F.expr("substring(text, 1, cut)"))
    while True:
        heavy = rows.filter((F.col("cut") == cut) & (F.col("salt") < 0)).groupBy(prefix.alias("heavy")).agg(
            F.sum(F.octet_length("text").cast("long") + 16).alias("bytes"), F.count(F.lit(1)).alias("copies"),
            F.max(F.length("text")).alias("longest"),
        ).filter(F.col("bytes") > range_bytes)
        heavy = stage(heavy.select("heavy", "copies", (F.col("longest") > cut).alias("grows")), "heavy-prefixes")
        kinds = {r.grows for r in heavy.select("grows").distinct().collect()}
        if not kinds:
            break
        salted |= False in kinds
        parts = F.ceil(F.sqrt("copies")).cast("int")
        rows = rows.withColumn("key", prefix).join(F.broadcast(heavy), F.col("key") == F.col("heavy"), "left").select(
            *texts.columns, F.when(F.col("grows"), F.lit(cut * GROWTH)).otherwise(F.col("cut")).alias("cut"),
            F.when(~F.col("grows"), F.pmod(F.xxhash64("entry"), parts).cast("int")).otherwise(F.col("salt")).alias("salt"),
        )
        if True not in kinds:
            break
        cut *= GROWTH
    return rows.withColumn("key", prefix), salted


def repeated_texts(texts: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """For each ``entry`` (columns entry, least, text) the smallest ``least`` of all entries of the same whole text."""
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = blocks_of(total, PARTITION_BYTES, 8)
    columns = ["key", "salt", "entry", "least", "text"]

    def tries(rows: DataFrame) -> DataFrame:
        dealt = rows.select(*columns).repartition(parts, "key", "salt").sortWithinPartitions("key", "salt")
        return dealt.mapInArrow(_range_tries, "entry long, top long, least long, text string")

    rows, salted = _ranged(texts, range_bytes)
    found = stage(tries(rows), "range-tries")
    if not salted:
        return found.select("entry", "least")
    # Of a text that is a range of its own, each salted part sends one copy.
    tops = found.filter("text is not null").select(
        F.xxhash64("text").alias("key"), F.lit(-1).alias("salt"), F.col("entry"), "least", "text"
    )
    whole = tries(tops).select(F.col("entry").alias("whole"), F.col("least").alias("lowest"))
    return found.join(whole, F.col("top") == F.col("whole"), "left").select("entry", F.coalesce("lowest", "least").alias("least"))


def filter_masks(
    documents: DataFrame, checks: dict[str, Check] | None = None, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "source", range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """For each document ``id``, ``part`` and ``mask``: bit n is set where the n-th check fails, the last bit (one past
    the checks) where a smaller id has the identical text.

    Null text counts as empty, null part as the empty string. Every row gives one, repeated rows too; rows of one id
    are no smaller than each other, and rows without an id neither fail nor cause the last check. Very long texts are
    whole in the tries. An empty table gives no rows; other columns do not matter, whatever their names.
    """
    checks = CHECKS if checks is None else checks
    # One pass over the text for each check, none of it repeated in Python.
    bits = [F.when(check(text_of(text_col)), F.lit(1 << n)).otherwise(F.lit(0)) for n, check in enumerate(checks.values())]
    masked = documents.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        sum(bits, F.lit(0)).cast("int").alias("mask"), text_of(text_col).alias("text"),
    )
    local = stage(
        masked.mapInArrow(_local_tries, "id long, part string, mask int, entry long, least long, text string"), "local-tries"
    )
    least = repeated_texts(local.filter("text is not null").select("entry", "least", "text"), range_bytes)
    known = least.select(F.col("entry").alias("found"), F.col("least").alias("lowest"))
    repeated = F.coalesce(F.col("id") > F.col("lowest"), F.lit(False))
    return local.select("id", "part", "mask", "entry").join(known, F.col("entry") == F.col("found")).select(
        "id", "part", F.when(repeated, F.col("mask").bitwiseOR(F.lit(1 << len(checks)))).otherwise(F.col("mask")).alias("mask")
    )


def audit_filters(masks: DataFrame, labels: DataFrame, letters: str, id_col: str = "doc_id") -> DataFrame:
    """Per part, order of the filters (``letters``, bit n of the mask is letter n) and step: what each filter does there.

    Documents count as good or toxic where any row of ``labels`` says so; others as neither. All that is needed of the
    documents is, for each set of filters, how many fail none of them: orders are expanded after that.
    """
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = masks.groupBy("id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    marked = rows.join(marks, F.col("id") == F.col("labelled"), "left")
    counted = marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(F.lit(0))).alias(c) for c in ("good", "toxic")]
    )
    everything = (1 << len(letters)) - 1

    def passing(column: str, chosen: int) -> Column:
        none = F.col("mask").bitwiseAND(F.lit(chosen)) == 0
        return F.sum(F.when(none, F.col(column)).otherwise(F.lit(0)))

    orders = list(permutations(range(len(letters))))
    # A document is removed by each of the filters it fails in as many orders as by any other.
    share = F.lit(len(orders)) / F.bit_count("mask")
    shapley = [
        F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << n)) != 0, (F.col("n") * share).cast("long")).otherwise(F.lit(0)))
        for n in range(len(letters))
    ]
    parts = counted.groupBy("part").agg(
        *[F.array(*[passing(c, chosen) for chosen in range(everything + 1)]).alias(f"{c}_left") for c in ("n", "good", "toxic")],
        F.array(*shapley).alias("shares"),
    )
    steps = [
        F.struct(
            F.lit("".join(letters[n] for n in order)).alias("filter_order"), F.lit(step + 1).alias("step"), F.lit(order[step]).alias("bit"),
            F.lit(sum(1 << n for n in order[:step])).alias("before"),
        )
        for order in orders for step in range(len(order))
    ]
    each = parts.select("*", F.inline(F.array(*steps)))
    flag = F.expr("shiftleft(1, bit)")
    after = F.col("before").bitwiseOR(flag)
    at = lambda column, chosen: F.get(f"{column}_left", chosen)
    gone = lambda column: at(column, F.col("before")) - at(column, after)
    failing = at("n", F.lit(0)) - at("n", flag)
    return each.select(
        "part", "filter_order", "step", at("n", after).alias("kept"), gone("n").alias("removed"), (failing - gone("n")).alias("redundant"),
        (at("n", F.lit(everything) - flag) - at("n", F.lit(everything))).alias("unique_fails"), gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"), F.get("shares", F.col("bit")).alias("shapley"),
    )
