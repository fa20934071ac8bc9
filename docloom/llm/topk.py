"""Exact top-k by inner product with the three-phase uniform threshold algorithm.

Vectors are cut into segments, and each segment of each block of vectors is a list of partial scores. The lists'
foremost entries give a safe cutoff; each list then gives all entries that reach an equal share of it; the scores of
what the lists gave are resolved exactly, where the vectors are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.vectors import largest, matrix, over_grid, searched
from docloom.session import stage

# Segments of a vector, and the components of one, so that sums of products stay exact in double precision where
# components are below LARGEST; queries whose larger products are computed together.
SEGMENTS, WIDEST, DIGIT, TOGETHER = 2, 256, 22, 64
LARGEST = 2.0**DIGIT
LEAST_LONG, MOST_LONG = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _segments(width: int) -> list[slice]:
    count = min(width, max(SEGMENTS, -(-width // WIDEST)))
    bounds = [width * i // count for i in range(count + 1)]
    return [slice(a, b) for a, b in zip(bounds, bounds[1:])]


def _digits(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers in base 2^22, lowest digit first; only the last one has a sign."""
    found = []
    while np.abs(x).max(initial=0) >= LARGEST:
        higher = np.floor(x / LARGEST)
        found.append(x - higher * LARGEST)
        x = higher
    return [*found, x]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers of any size; those beyond a long become its nearest end."""
    one, other = _digits(a), _digits(b)
    total = [np.zeros((len(a), len(b)), dtype=np.int64) for _ in range(max(4, len(one) + len(other)))]
    for i, x in enumerate(one):
        for j, y in enumerate(other):
            for start in range(0, a.shape[1], WIDEST):
                cut = slice(start, start + WIDEST)
                total[i + j] += (x[:, cut] @ y[:, cut].T).astype(np.int64)
    for i in range(len(total) - 1):
        total[i + 1] += total[i] >> DIGIT
        total[i] &= (1 << DIGIT) - 1
    negative = total[-1] < 0
    # 63 bits: two digits and 19 bits of the third; all above them repeat the sign.
    fits = total[2] >> (63 - 2 * DIGIT) == np.where(negative, (1 << (3 * DIGIT - 63)) - 1, 0)
    for digit in total[3:-1]:
        fits &= digit == np.where(negative, (1 << DIGIT) - 1, 0)
    fits &= total[-1] == np.where(negative, -1, 0)
    low = total[0] | total[1] << DIGIT | total[2] << 2 * DIGIT
    return np.where(fits, low, np.where(negative, LEAST_LONG, MOST_LONG))


SCORED = "query_id long, vec_id long, score long"


def _scored(sought: np.ndarray, ids: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    query, at, score = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, dtype=np.int64)] * 3
    columns = (sought[query.astype(np.int64)], ids[at.astype(np.int64)], score.astype(np.int64))
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})


def top_k(
    vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """For each query the ``k`` highest inner products: query_id, rank from 1, vec_id, score (a whole number).

    Each component x counts as floor(scale * x). Queries are the vectors for whose ``id`` the column function
    ``is_query`` holds; a query's own id is no candidate. Ties go to the smaller id; fewer candidates than ``k`` are
    all returned. Null vectors and vectors with null or non-finite components take no part, nor do rows without an id.
    Of rows with the same id the smallest vector counts; shorter vectors, also empty ones, count as ending in zeros. An
    empty table gives no rows. A score beyond a long is shown as the nearest long and ties with others like it.

    Products with vectors that have a component of 2^22 or more after scaling are not exact in double precision. They
    are computed in whole numbers for each block, which gives its ``k`` highest of them.

    Entries are right to be left out: a vector whose parts all stay below an equal share of the cutoff stays below the
    cutoff, and ``k`` vectors reach it. This holds for negative scores too. Between the phases only ``k`` rows for each
    query and block are shuffled, and the cutoff goes to the blocks with the queries.
    """
    most = float(np.finfo(float).max)
    scaled = lambda x: F.greatest(F.least(x * F.lit(float(scale)), F.lit(most)), F.lit(-most))
    live = stage(searched(vectors, id_col, vector_col, least=0).select("id", F.transform("vec", scaled).alias("vec")), "vectors")
    width = live.agg(F.max(F.size("vec"))).first()[0] or 1
    cuts = _segments(width)
    queries = live.filter(is_query(F.col("id"))).select(F.col("id").alias("query_id"), F.col("vec").alias("query"))

    def lists(rows: pa.Table, asked: pa.Table):
        """Ids, query ids, for each segment the parts of all queries (rows) and vectors, and the highest exact scores.

        A query's own vector and pairs with large components have no parts.
        """
        ids, sought = rows.column("id").to_numpy(), asked.column("query_id").to_numpy()
        block, wanted = np.floor(matrix(rows.column("vec"), width)), np.floor(matrix(asked.column("query"), width))
        own = sought[:, None] == ids
        large, large_query = ((np.abs(x) >= LARGEST).any(axis=1) for x in (block, wanted))
        exact = []
        for queries_at, rows_at in ((~large_query, large), (large_query, large | True)):
            queries_at, rows_at = np.flatnonzero(queries_at), np.flatnonzero(rows_at)
            for start in range(0, len(queries_at) if len(rows_at) else 0, TOGETHER):
                some = queries_at[start : start + TOGETHER]
                for query, score in zip(some, exact_products(wanted[some], block[rows_at])):
                    others = ~own[query, rows_at]
                    at, score = rows_at[others], score[others]
                    best = np.lexsort((ids[at], ~score))[:k]
                    exact.append((np.full(len(best), query), at[best], score[best]))
        none = own | large | large_query[:, None]
        block[large], wanted[large_query] = 0, 0
        return ids, sought, [np.where(none, -np.inf, wanted[:, cut] @ block[:, cut].T) for cut in cuts], exact

    def whole(parts: list[np.ndarray], query: np.ndarray, at: np.ndarray) -> np.ndarray:
        return sum(part[query, at].astype(np.int64) for part in parts)

    def foremost(rows: pa.Table, asked: pa.Table) -> pa.Table:
        """Phase 1: the vectors that head some list of the block, with their scores."""
        ids, sought, parts, exact = lists(rows, asked)
        if not len(ids) or not len(sought):
            return _scored(sought, ids, [])
        heads = np.zeros((len(sought), len(ids)), dtype=bool)
        for part in parts:
            best = np.argpartition(-part, min(k, len(ids)) - 1, axis=1)[:, :k]
            np.put_along_axis(heads, best, True, axis=1)
        query, at = np.nonzero(heads & np.isfinite(parts[0]))
        return _scored(sought, ids, [(query, at, whole(parts, query, at)), *exact])

    blocks = live.select("id", "vec")
    heads = over_grid(blocks, queries, "id", "query_id", foremost, SCORED)
    cutoffs = largest(heads, ["query_id"], "score", "vec_id", k).groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("cut")
    )

    def sufficient(rows: pa.Table, asked: pa.Table) -> pa.Table:
        """Phases 2 and 3: entries that reach their list's share of the cutoff, resolved; those below it go."""
        ids, sought, parts, exact = lists(rows, asked)
        if not len(ids) or not len(sought):
            return _scored(sought, ids, [])
        cut = asked.column("cut").fill_null(LEAST_LONG).to_numpy()
        # Parts are whole numbers, and a share of more than 2^53, which is rounded here, is beyond all of them.
        share = (cut // len(cuts)).astype(float)
        given = np.zeros((len(sought), len(ids)), dtype=bool)
        for part in parts:
            given |= (part >= share[:, None]) & np.isfinite(part)
        query, at = np.nonzero(given)
        score = whole(parts, query, at)
        reach = score >= cut[query]
        return _scored(sought, ids, [(query[reach], at[reach], score[reach]), *exact])

    told = queries.join(cutoffs, "query_id", "left")
    scored = over_grid(blocks, told, "id", "query_id", sufficient, SCORED)
    return largest(scored, ["query_id"], "score", "vec_id", k).select("query_id", "rank", "vec_id", "score")
