"""Hard negatives by blocks of vectors in Hilbert order, with a zone map for each block.

Candidates are written as Parquet in the order of a Hilbert curve and cut into blocks; the zone map of a block holds the
smallest and largest component of every dimension, and its labels. Interval arithmetic on a zone map bounds the scores
of the whole block, and an anchor reads the blocks whose bounds meet one of its windows.

Which anchor reads which block is many rows in few bytes of Parquet, by whose size Spark would choose what to broadcast.
Joins are therefore merged, so that the driver holds no table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.shared import blocks_of
from docloom.llm.topk import exact_products
from docloom.llm.vectors import largest, matrix, over_grid, usable
from docloom.session import stage

# Rows of a block, blocks of a shelf, anchors that meet it together, anchors whose scores are held at once, and the
# cells of shelves and anchors that a small table still makes.
ROWS, SHELF, ANCHORS, TOGETHER, CELLS = 1024, 8, 8192, 128, 32
# Dimensions of the curve and bits of each; the widest ones are taken.
CURVE_DIMS, CURVE_BITS = 8, 5
BEGIN, END = np.iinfo(np.int64).min, np.iinfo(np.int64).max
ALIKE = "anchor_id long, positive_id long, score long"
FOUND = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def _joined(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of which neither side is broadcast: a small file can hold a large table."""
    return left.join(right.hint("merge"), on, how)


def _whole(rows: DataFrame, scale: int) -> DataFrame:
    """``rows`` (id, label, vec) with floor(scale * x) for each component x, as doubles of at most the largest one."""
    most = np.finfo(float).max

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vec")
            with np.errstate(over="ignore"):
                x = np.floor(np.clip(lists.flatten().to_numpy(zero_copy_only=False) * float(scale), -most, most))
            offsets = np.asarray(lists.offsets)
            vec = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(x, pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), vec], names=["id", "label", "vec"])

    return rows.select("id", "label", "vec").mapInArrow(floored, "id long, label long, vec array<double>")


class Packing(NamedTuple):
    """Vectors as bytes: whole numbers of ``kind``, ``width`` of them."""

    width: int
    kind: str

    @classmethod
    def of(cls, rows: DataFrame) -> Packing:
        """The narrowest kind that holds all components of the arrays ``vec``."""
        size, most = rows.agg(F.max(F.size("vec")), F.max(F.array_max(F.transform("vec", F.abs)))).first()
        return cls(size or 1, next((k for k, bits in (("<i2", 15), ("<i4", 31)) if (most or 0) < 2.0**bits), "<f8"))

    def pack(self, x: np.ndarray) -> pa.Array:
        data = pa.py_buffer(np.ascontiguousarray(x.astype(self.kind)))
        bytes_each = self.width * np.dtype(self.kind).itemsize
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(bytes_each), len(x), [None, data]).cast(pa.binary())

    def matrix(self, packed: pa.ChunkedArray | pa.Array) -> np.ndarray:
        """Vectors as rows of doubles."""
        found = (packed.combine_chunks() if isinstance(packed, pa.ChunkedArray) else packed).cast(pa.binary())
        if not len(found):
            return np.zeros((0, self.width))
        start = np.frombuffer(found.buffers()[1], np.int32)[found.offset]
        values = np.frombuffer(found.buffers()[2], self.kind, len(found) * self.width, start)
        return values.reshape(len(found), self.width).astype(float)


def hilbert(levels: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of whole coordinates (0 to 2^bits - 1) on the Hilbert curve through their cube."""
    x = levels.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            turned = (x[d] >> bit & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= flip
    place = np.zeros_like(flip)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            place = place << 1 | (x[d] >> bit & 1)
    return place


def _spreads(rows: DataFrame, width: int) -> list[tuple[int, float, float]]:
    """Dimension, mean and deviation of the widest dimensions, over all rows, of asinh of the components."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.arcsinh(matrix(pa.chunked_array([batch.column(0)]), width))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width)), pa.array(np.full(width, len(x))), pa.array(x.sum(axis=0)), pa.array((x * x).sum(axis=0))],
                names=["dim", "n", "total", "squares"],
            )

    whole = rows.select("vec").mapInArrow(sums, "dim long, n long, total double, squares double").groupBy("dim").agg(
        (F.sum("total") / F.sum("n")).alias("mean"), (F.sum("squares") / F.sum("n")).alias("square")
    )
    spread = F.sqrt(F.greatest(F.col("square") - F.col("mean") ** 2, F.lit(0.0))).alias("spread")
    widest = whole.select("dim", "mean", spread).orderBy(F.desc("spread"), "dim").limit(CURVE_DIMS).collect()
    return [(r.dim, r.mean, r.spread) for r in widest]


def _blocks(rows: DataFrame, packing: Packing) -> DataFrame:
    """``rows`` (id, label, vec) packed and written in Hilbert order, with ``block``; none has more than ``ROWS``."""
    width = packing.width
    spreads = _spreads(rows, width)

    def on_curve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = matrix(pa.chunked_array([batch.column("vec")]), width)
            x = np.arcsinh(whole)
            levels = np.zeros((len(x), CURVE_DIMS))
            for at, (dim, mean, spread) in enumerate(spreads):
                levels[:, at] = (x[:, dim] - mean) / (spread or 1.0) * 2 ** (CURVE_BITS - 2) + 2 ** (CURVE_BITS - 1)
            place = hilbert(np.clip(levels, 0, 2**CURVE_BITS - 1), CURVE_BITS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), packing.pack(whole), pa.array(place, pa.int64())],
                names=["id", "label", "vec", "curve"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, at = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            number = start + (at + np.arange(batch.num_rows)) // ROWS
            at += batch.num_rows
            yield batch.append_column("block", pa.array(number, pa.int64()))

    schema = "id long, label long, vec binary, curve long"
    placed = stage(rows.mapInArrow(on_curve, schema), "on-curve")
    ordered = placed.repartitionByRange(blocks_of(placed.count(), 8 * ROWS, 8), "curve", "id").sortWithinPartitions("curve", "id")
    return stage(ordered.mapInArrow(cut, schema + ", block long").drop("curve"), "blocks")


def _zones(blocks: DataFrame, packing: Packing) -> DataFrame:
    """For each block the smallest and largest whole component of each dimension, and its labels."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, labels = (batch.column(c).to_numpy() for c in ("block", "label"))
            x = packing.matrix(batch.column("vec"))
            for block in np.unique(number):
                mine = number == block
                yield pa.RecordBatch.from_pylist([{
                    "block": int(block), "low": x[mine].min(axis=0).tolist(), "high": x[mine].max(axis=0).tolist(),
                    "labels": np.unique(labels[mine]).tolist(),
                }], schema=zone)

    zone = pa.schema([("block", pa.int64()), *[(c, pa.list_(pa.float64())) for c in ("low", "high")], ("labels", pa.list_(pa.int64()))])
    parts = blocks.mapInArrow(partial, "block long, low array<double>, high array<double>, labels array<long>")

    def merged(whole: pa.Table) -> pa.Table:
        low, high = (matrix(whole.column(c), packing.width) for c in ("low", "high"))
        low, high = low.min(axis=0), high.max(axis=0)
        labels = np.unique(whole.column("labels").combine_chunks().flatten())
        return pa.Table.from_pylist([{
            "block": whole.column("block")[0].as_py(), "low": low.tolist(), "high": high.tolist(), "labels": labels.tolist()
        }], schema=zone)

    return parts.groupBy("block").applyInArrow(merged, "block long, low array<double>, high array<double>, labels array<long>")


def _meeting(zones: DataFrame, asked: DataFrame, packing: Packing, same: bool) -> DataFrame:
    """``asked`` for each ``shelf`` of blocks with ``reads``, whose bits are the blocks of the shelf that an anchor reads.

    A block is read where a score of it can lie in a window of the anchor; ``asked`` has arrays ``lows`` and ``highs``
    of the windows' ends. Blocks of one label are left out where the label rules them out. Bounds are widened by what
    rounding can take from them.
    """

    def cell(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        low, high = matrix(rows.column("low"), packing.width), matrix(rows.column("high"), packing.width)
        far = np.maximum(np.abs(low), np.abs(high))
        blocks, ids = rows.column("block").to_numpy(), anchors.column("anchor_id").to_numpy()
        shelves, first = np.unique(blocks // SHELF, return_index=True)
        has = [set(x) for x in rows.column("labels").to_pylist()]
        known, which = np.unique(anchors.column("label").to_numpy(), return_inverse=True)
        fit = np.array(
            [[x in h if same else len(h) > 1 or x not in h for h in has] for x in known.tolist()], dtype=bool
        ).reshape(len(known), len(has))
        found = []
        for start in range(0, len(ids) if len(blocks) else 0, TOGETHER):
            some = anchors.slice(start, TOGETHER)
            lows, highs = _windows(some)
            with np.errstate(over="ignore", invalid="ignore"):
                a = packing.matrix(some.column("vec"))
                up, down = np.maximum(a, 0), np.minimum(a, 0)
                slack = 1 + 1e-9 * (np.abs(a) @ far.T)
                most, least = up @ high.T + down @ low.T + slack, up @ low.T + down @ high.T - slack
            meets = np.zeros(most.shape, dtype=bool)
            for begin, end in zip(lows.T[:, :, None], highs.T[:, :, None]):
                # Bounds that are no numbers rule nothing out, and scores beyond a long count as its ends.
                reach = (begin == BEGIN) | ~(most < begin.astype(float))
                meets |= reach & ((end == END) | ~(least > end.astype(float))) & (begin <= end)
            meets &= fit[which[start : start + TOGETHER]]
            reads = np.add.reduceat(meets * (1 << blocks % SHELF), first, axis=1)
            anchor, shelf = np.nonzero(reads)
            found.append((ids[start + anchor], shelves[shelf], reads[anchor, shelf]))
        return _table(found, ("anchor_id", "shelf", "reads"))

    # Both are counted before they are met, and what is read is read twice.
    asked, shelved = stage(asked, "windows"), zones.withColumn("shelf", F.expr(f"block div {SHELF}"))
    met = over_grid(shelved, asked, "shelf", "anchor_id", cell, "anchor_id long, shelf long, reads long")
    return _joined(asked, stage(met, "to-read"), "anchor_id")


def _windows(asked: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The ends of each anchor's windows, a row for each; missing windows hold nothing."""
    lists = [asked.column(c).combine_chunks() for c in ("lows", "highs")]
    sizes = np.diff(np.asarray(lists[0].offsets))
    inside = np.arange(sizes.max(initial=0)) < sizes[:, None]
    ends = np.full(inside.shape, END), np.full(inside.shape, BEGIN)
    for end, values in zip(ends, lists):
        end[inside] = values.flatten().to_numpy()
    return ends


def _read(blocks: DataFrame, asked: DataFrame, chunks: int, cell: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``cell`` of each shelf of blocks with the anchors of ``asked`` that read one of them, dealt out to ``chunks``."""
    dealt = asked.withColumn("chunk", F.pmod(F.xxhash64("anchor_id"), F.lit(chunks)))
    wanted = dealt.groupBy("shelf", "chunk").agg(F.bit_or("reads").alias("wanted"))
    shelved = blocks.withColumn("shelf", F.expr(f"block div {SHELF}"))
    read = _joined(shelved, wanted, "shelf").filter(f"shiftright(wanted, cast(block % {SHELF} as int)) & 1 = 1").drop("wanted")
    # Both sides may come from the same table: new columns tell them apart.
    left = read.select(*[F.col(c).alias(c) for c in read.columns])
    right = dealt.select(*[F.col(c).alias(c) for c in dealt.columns])
    return left.groupBy("shelf", "chunk").cogroup(right.groupBy("shelf", "chunk")).applyInArrow(cell, schema)


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; in single or double precision where no sum can reach 2^24 or 2^53."""
    most = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if most < 2.0**24:
        anchors, rows = anchors.astype(np.float32), rows.astype(np.float32)
    return (anchors @ rows.T).astype(np.int64) if most < 2.0**53 else exact_products(anchors, rows)


def _scored(rows: pa.Table, asked: pa.Table, packing: Packing) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block, and some anchors that read it, their positions, the ids and labels of its rows by id, and the scores."""
    ids, labels, number = (rows.column(c).to_numpy() for c in ("id", "label", "block"))
    x, anchors, reads = packing.matrix(rows.column("vec")), packing.matrix(asked.column("vec")), asked.column("reads").to_numpy()
    for block in np.unique(number):
        mine = np.flatnonzero(number == block)
        mine = mine[np.argsort(ids[mine])]
        reading, own = np.flatnonzero(reads >> block % SHELF & 1), x[mine]
        for start in range(0, len(reading), TOGETHER):
            at = reading[start : start + TOGETHER]
            yield at, ids[mine], labels[mine], _products(anchors[at], own)


def _falling(row: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The order of entries that come row by row, the highest of each row first; equal ones stay in their order."""
    # ~x falls as x rises, and has no overflow.
    return np.lexsort((~score, row))


def _foremost(row: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first ``k`` of their row; rows come one after the other."""
    return np.arange(len(row)) - np.searchsorted(row, row) < k


def windows_of(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score.

    Scores are inner products of floor(scale * x). An anchor (a row for whose id the column function ``is_anchor``
    holds) has as positives the ``positives`` highest other rows of its label; for each of them the ``negatives`` highest
    rows of other labels are returned whose score is between ``low`` and ``high`` hundredths of the positive's. Ties go
    to the smaller id; fewer are all returned. Rows with null id, label or vector or with null or non-finite components
    take no part; of rows with one id the smallest (label, vector) counts. Shorter vectors, also empty ones, count as ending in zeros.
    A score beyond a long counts as the nearest long. An empty table gives no rows; other columns do not matter.

    The first look is at the anchor's own block and gives cutoffs; then only blocks are read whose bounds reach them.
    What bounds cannot rule out is read, so that no row is lost where they are wide.
    """
    # Floats are half as wide until they are scaled, and in the same order.
    kind = "array<float>" if dict(vectors.dtypes).get(vector_col) == "array<float>" else "array<double>"
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast(kind).alias("vec"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec")))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row"))
    live = stage(_whole(one.select("id", "row.label", F.col("row.vec").cast("array<double>").alias("vec")), scale), "labelled")
    packing = Packing.of(live)
    blocks = _blocks(live, packing)
    zones = stage(_zones(blocks, packing), "zones")
    own = F.expr(f"block div {SHELF}").alias("shelf"), F.expr(f"shiftleft(1L, cast(block % {SHELF} as int))").alias("reads")
    anchors = stage(blocks.filter(is_anchor(F.col("id"))).select(F.col("id").alias("anchor_id"), "label", "vec", *own), "anchors")
    chunks = blocks_of(anchors.count(), ANCHORS, -(-CELLS // blocks_of(zones.count(), SHELF)))

    def alike(rows: pa.Table, asked: pa.Table) -> pa.Table:
        names, mine, found = asked.column("anchor_id").to_numpy(), asked.column("label").to_numpy(), []
        cuts = _windows(asked)[0]
        for at, ids, labels, scores in _scored(rows, asked, packing):
            i, j = np.nonzero(scores >= cuts[at])
            fits = (labels[j] == mine[at[i]]) & (ids[j] != names[at[i]])
            i, j = i[fits], j[fits]
            order = _falling(i, scores[i, j])
            best = order[_foremost(i, positives)]
            found.append((names[at[i[best]]], ids[j[best]], scores[i[best], j[best]]))
        return _table(found, ("anchor_id", "positive_id", "score"))

    def highest(asked: DataFrame, parts: int) -> DataFrame:
        return largest(_read(blocks, asked, parts, alike, ALIKE), ["anchor_id"], "score", "positive_id", positives)

    everything = {"lows": F.array(F.lit(int(BEGIN))), "highs": F.array(F.lit(int(END)))}
    first = highest(anchors.withColumns(everything), 1).groupBy("anchor_id").agg(
        F.when(F.count(F.lit(1)) >= positives, F.min("score")).alias("cut")
    )
    told = _joined(anchors.drop("shelf", "reads"), first, "anchor_id", "left").withColumns(
        everything | {"lows": F.array(F.coalesce("cut", F.lit(int(BEGIN))))}
    ).drop("cut")
    matched = highest(_meeting(zones, told, packing, same=True), chunks).select("anchor_id", "positive_id", "score")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [windows_of(score, low, high) for score in batch.column("score").to_pylist()]
            held = pa.array([begin <= end and begin <= END and end >= BEGIN for begin, end in ends], pa.bool_())
            begins, tails = (pa.array([min(max(x[side], int(BEGIN)), int(END)) for x in ends], pa.int64()) for side in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, begins, tails], names=[*group, "begin", "end"]).filter(held)

    group = ["anchor_id", "positive_id", "positive_score"]
    pairs = stage(matched.mapInArrow(windows, ", ".join(f"{c} long" for c in (*group, "begin", "end"))), "positives")

    def hard(rows: pa.Table, asked: pa.Table) -> pa.Table:
        names, mine, found = asked.column("anchor_id").to_numpy(), asked.column("label").to_numpy(), []
        lows, highs = _windows(asked)
        chosen, own_scores = (asked.column(c).combine_chunks().flatten().to_numpy() for c in ("positives", "scores"))
        first_of = _starts(asked)
        for at, ids, labels, scores in _scored(rows, asked, packing):
            begin, end = lows[at], highs[at]
            i, j = np.nonzero((scores >= begin.min(axis=1, keepdims=True)) & (scores <= end.max(axis=1, keepdims=True)))
            other = labels[j] != mine[at[i]]
            i, j = i[other], j[other]
            order = _falling(i, scores[i, j])
            i, j = i[order], j[order]
            score = scores[i, j]
            for window in range(lows.shape[1]):
                inside = np.flatnonzero((score >= begin[i, window]) & (score <= end[i, window]))
                best = inside[_foremost(i[inside], negatives)]
                pair = first_of[at[i[best]]] + window
                found.append((names[at[i[best]]], chosen[pair], ids[j[best]], own_scores[pair], score[best]))
        return _table(found, ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"))

    def with_windows(each: DataFrame) -> DataFrame:
        paired = each.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score", "begin", "end")).alias("each"))
        named = {"positives": "positive_id", "scores": "positive_score", "lows": "begin", "highs": "end"}
        return _joined(anchors, paired, "anchor_id").select(*anchors.columns, *[F.col(f"each.{c}").alias(n) for n, c in named.items()])

    near = largest(_read(blocks, with_windows(pairs), 1, hard, FOUND), group, "negative_score", "negative_id", negatives)
    cuts = near.groupBy(*group).agg(F.when(F.count(F.lit(1)) >= negatives, F.min("negative_score")).alias("cut"))
    narrowed = _joined(pairs, cuts, group, "left").withColumn("begin", F.greatest("begin", "cut"))
    asking = _meeting(zones, with_windows(narrowed).drop("shelf", "reads"), packing, same=False)
    found = largest(_read(blocks, asking, chunks, hard, FOUND), group, "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _starts(asked: pa.Table) -> np.ndarray:
    """Where each anchor's windows start among those of all."""
    offsets = np.asarray(asked.column("lows").combine_chunks().offsets)
    return offsets[:-1] - offsets[:1]


def _table(found: list[tuple[np.ndarray, ...]], names: tuple[str, ...]) -> pa.Table:
    columns = [np.concatenate(x) for x in zip(*found)] or [np.zeros(0, dtype=np.int64)] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})
