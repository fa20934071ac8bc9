"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Inverted files hold, for each pivot, the place that it has in
the vectors' permutations. A query reads the files of its own nearest pivots, ranks the vectors by the footrule
distance of the permutations, and computes true cosines for the foremost of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.vectors import largest, matrix, over_grid, searched

# Pivots, how many of them a permutation holds, and the part (with a least number) of a block that is reranked.
PIVOTS, LENGTH, PART, LEAST = 256, 128, 0.06, 64
# Pivots that are this many places apart on average, at most, belong to near copies, which are all reranked.
NEAR = 4
# Vectors that pivots are chosen from, for each pivot, and the cosine from which on two of them make one pivot: the order
# of pivots that are near copies says nothing.
SAMPLE, SAME = 4, 0.95


def choose_pivots(vectors: DataFrame, width: int, pivots: int) -> np.ndarray:
    """From a bounded sample, the ids of smallest hash: at most ``pivots`` unit vectors that are no near copies."""
    found = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE * pivots).select("vec").toArrow().column("vec")
    sample = unit(matrix(found, width))
    chosen: list[int] = []
    for i, near in enumerate(sample @ sample.T > SAME):
        if len(chosen) < pivots and not near[chosen].any():
            chosen.append(i)
    return sample[chosen]


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = _scaled(rows)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, which changes no digit, so that large and tiny components do not overflow."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1]) if len(rows) else rows


def index(vectors: DataFrame, pivots: np.ndarray, length: int) -> DataFrame:
    """Every vector with ``perm``, the numbers of its nearest pivots, nearest first, as 16-bit numbers."""
    width = pivots.shape[1]
    names = vectors.columns

    def permuted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = unit(matrix(pa.chunked_array([batch.column(names.index("vec"))]), width)) @ pivots.T
            order = np.argsort(-near, axis=1, kind="stable")[:, :length].astype("<u2")
            perms = pa.array([row.tobytes() for row in order], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, perms], names=[*names, "perm"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(permuted, f"{fields}, perm binary")


def permutations(column: pa.ChunkedArray, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, length).astype(np.int64)


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
    length: int = LENGTH,
    part: float = PART,
) -> DataFrame:
    """For each query the ``k`` nearest vectors found: query_id, rank from 1, vec_id, score.

    Queries are the vectors for whose ``id`` the column function ``is_query`` holds; a query's own id is no candidate.
    The score is the cosine of the original vectors in double precision, ties go to the smaller id, and fewer
    candidates than ``k`` are all returned. Null and zero vectors and vectors with null or non-finite components take
    no part, nor do rows without an id; of rows with the same id the smallest vector counts, and shorter vectors count
    as ending in zeros. An empty table gives no rows.

    Every vector is indexed. A cell of the grid holds a block of vectors with its inverted files and a block of
    queries, and reranks the ``part`` of its block that is foremost by footrule, but at least 64 vectors, all that tie
    with the last of them, and all near copies of the query whatever their number. Of equal vectors of a block only the
    ``k`` + 1 of smallest id are looked at, as no others can be among the nearest. The index is fitted on ``pivots``
    vectors.
    """
    live = searched(vectors, id_col, vector_col).filter(F.exists("vec", lambda x: x != 0))
    width = live.agg(F.max(F.size("vec"))).first()[0] or 1
    chosen = choose_pivots(live, width, pivots)
    length = min(length, len(chosen))
    indexed = index(live, chosen, length) if len(chosen) else live.withColumn("perm", F.lit(b""))
    queries = indexed.filter(is_query(F.col("id"))).select(F.col("id").alias("query_id"), F.col("vec").alias("query"), "perm")

    def cell(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, sought = (t.column(c).to_numpy() for t, c in ((rows, "id"), (asked, "query_id")))
        found: list[tuple[np.ndarray, ...]] = []
        if len(ids) and len(sought):
            raw, asked_raw = matrix(rows.column("vec"), width), matrix(asked.column("query"), width)
            again = max(LEAST, int(part * len(ids)))
            kept = _foremost_copies(raw, ids, k + 1)
            raw, ids, perms = raw[kept], ids[kept], permutations(rows.column("perm"), length)[kept]
            units, wanted = unit(raw), unit(asked_raw)
            # The files: one row for each pivot, with its place in each vector's permutation, or the length.
            files = np.full((len(chosen), len(ids)), length, dtype=np.int16)
            files[perms, np.arange(len(ids))[:, None]] = np.arange(length, dtype=np.int16)
            places = np.arange(length, dtype=np.int16)[:, None]
            again = min(len(ids), again)
            for i, perm in enumerate(permutations(asked.column("perm"), length)):
                footrule = np.abs(files[perm] - places).sum(axis=0, dtype=np.int32)
                front = np.flatnonzero(footrule <= max(np.partition(footrule, again - 1)[again - 1], NEAR * length))
                front = front[ids[front] != sought[i]]
                rough = units[front] @ wanted[i]
                if len(front) > k:
                    front = front[rough >= np.partition(rough, len(front) - k)[len(front) - k] - 1e-9]
                score = cosines(raw[front], np.broadcast_to(asked_raw[i], (len(front), width)))
                best = np.lexsort((ids[front], -score))[:k]
                found.append((np.full(len(best), sought[i]), ids[front][best], score[best]))
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    scored = over_grid(indexed.select("id", "vec", "perm"), queries, "id", "query_id", cell, "query_id long, vec_id long, score double")
    return largest(scored, ["query_id"], "score", "vec_id", k).select("query_id", "rank", "vec_id", "score")


def _foremost_copies(rows: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the rows that fewer than ``most`` equal rows of smaller id stand before."""
    kind = np.unique(rows + 0.0, axis=0, return_inverse=True)[1].reshape(-1)
    order = np.lexsort((ids, kind))
    first = np.searchsorted(kind[order], kind[order])
    return np.sort(order[np.arange(len(order)) - first < most])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; a row's result does not depend on the other rows."""

    def dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for i in range(x.shape[1]):
            total += x[:, i] * y[:, i]
        return total

    a, b = _scaled(a), _scaled(b)
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))
