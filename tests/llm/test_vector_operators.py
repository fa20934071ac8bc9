"""Nearest neighbours and exact top-k against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import Row, types as T

from docloom.llm import vectors as grid
from docloom.llm.ann import nearest
from docloom.llm.topk import exact_products, top_k

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    *[T.StructField(c, T.StringType()) for c in ("id", "vec", "query", "perm", "score", "rank")],
])


def frame(spark, rows):
    return spark.createDataFrame([Row(i, v, 0, *["x"] * 6) for i, v in rows], SCHEMA)


def vectors(n=600, width=16, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(width).astype(np.float32).tolist()) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    rows += [
        (n, None), (n + 50, [0.0] * width), (n + 100, [nan] * width), (n + 150, [inf] + [0.0] * 15), (n + 1, []), (None, rows[0][1]),
        (n + 2, [None] + rows[1][1][1:]), (n + 3, rows[0][1]), (n + 4, rows[0][1]), (5, rows[5][1]), (n + 5, rows[7][1][:3]),
    ]
    return rows


def usable(rows, zero):
    kept = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or (not zero and not any(v)):
            continue
        kept.setdefault(i, np.pad(np.array(v, dtype=float), (0, 16 - len(v))))
    return kept


def plain(kept, score, k):
    out = {}
    for q in sorted(i for i in kept if i % 50 == 0):
        ranked = sorted(((score(kept[q], v), i) for i, v in kept.items() if i != q), key=lambda x: (-x[0], x[1]))[:k]
        out[q] = ranked
    return out


def asked(vec_id):
    return vec_id % 50 == 0


@pytest.mark.parametrize("n", [600, 3])
def test_top_k(spark, n):
    rows = vectors(n) if n > 3 else [(0, [1.0, -2.5]), (50, [-0.1, 0.3]), (51, [2.0, 2.0])]
    whole = lambda a, b: int((np.floor(256 * a) * np.floor(256 * b)).sum())
    wanted = plain(usable(rows, True), whole, 5)
    got = {}
    for r in top_k(frame(spark, rows), asked).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got == wanted


def test_top_k_negative_scores_and_empty(spark):
    rows = [(i, [1.0 if i == 0 else -1.0 - i / 8, 0.5]) for i in range(30)]
    whole = lambda a, b: int((np.floor(256 * a[:2]) * np.floor(256 * b[:2])).sum())
    got = [(r.score, r.vec_id) for r in top_k(frame(spark, rows), asked).orderBy("rank").collect()]
    assert got == plain(usable(rows, True), whole, 5)[0] and max(got)[0] < 0
    assert top_k(frame(spark, []), asked).count() == 0


def test_nearest(spark):
    rows = vectors(2000)
    kept = usable(rows, False)
    cosine = lambda a, b: float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))
    wanted = plain(kept, cosine, 5)
    found = nearest(frame(spark, rows), asked, pivots=64, length=64).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert abs(r.score - cosine(kept[r.query_id], kept[r.vec_id])) < 1e-12
    assert got.keys() == wanted.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for _, i in wanted[q]} & set(got[q])) for q in got)
    assert hits >= 0.9 * 5 * len(got)
    assert got[0][:2] == [2003, 2004]  # equal vectors: the smaller id first


def test_nearest_few_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [1e30, 1e30]), (2, [-1e-30, 0.0]), (3, [0.0, 0.0])]
    got = [(r.rank, r.vec_id, round(r.score, 6)) for r in nearest(frame(spark, rows), asked).orderBy("rank").collect()]
    assert got == [(1, 1, 0.707107), (2, 2, -1.0)]
    assert nearest(frame(spark, []), asked).count() == 0


def hits(found, kept, k=5):
    """The share of the right neighbours, ties by id, that was found."""
    ids = np.array(sorted(kept))
    units = np.array([kept[i] / np.linalg.norm(kept[i]) for i in ids])
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    right = 0
    for q in got:
        score = units @ units[np.searchsorted(ids, q)]
        score[ids == q] = -2
        right += len(set(ids[np.lexsort((ids, -np.round(score, 12)))[:k]].tolist()) & got[q])
    return right / (k * len(got))


@pytest.mark.parametrize("noise", [0.0, 1e-4, 1e-2, 1e-1])
def test_nearest_where_a_third_are_copies(spark, monkeypatch, noise):
    """One block of 4096, so that the reranked part is far below the third."""
    monkeypatch.setattr(grid, "LEAST", 1)
    rng = np.random.default_rng(3)
    table = rng.standard_normal((4096, 64)).astype(np.float32)
    table[1::3] = table[1] + noise * rng.standard_normal((len(table[1::3]), 64)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(table)]
    kept = {i: np.array(v) for i, v in rows}
    found = nearest(frame(spark, rows), lambda i: i % 50 == 25).filter("query_id % 3 = 1").collect()
    assert len(found) == 5 * sum(i % 50 == 25 and i % 3 == 1 for i in kept)
    assert hits(found, kept) >= (1.0 if noise == 0 else 0.95)


def test_exact_products():
    rng = np.random.default_rng(8)
    for bits in (3, 22, 31, 40, 63, 130):
        a, b = (np.floor(rng.standard_normal((9, 300)) * 2.0**bits) for _ in range(2))
        b[0] = 0
        b[1, 5:], a[:, :5] = 0, 2.0**20
        right = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert exact_products(a, b).tolist() == [[min(max(s, -(2**63)), 2**63 - 1) for s in p] for p in right]
    edge = np.array([[2.0**62, 2.0**62, -1.0], [-(2.0**62), -(2.0**62), 0.0], [-(2.0**62), -(2.0**62), -1.0]])
    assert exact_products(edge, np.array([[1.0, 1.0, 1.0]])).tolist() == [[2**63 - 1], [-(2**63)], [-(2**63)]]


def test_top_k_keeps_large_components_and_empty_vectors(spark):
    rows = vectors(600)
    rows = [(i, [x * 3e5 for x in v] if i is not None and i % 3 == 0 and v and None not in v else v) for i, v in rows]
    rows += [(700, [3e6] * 16), (701, [-3e6] * 16), (702, [1e30] + [0.0] * 15), (703, [2.0] * 16), (704, [-1.0] * 16)]
    kept = usable(rows, True) | {601: np.zeros(16)}
    kept = {i: np.float32(v).astype(float) for i, v in kept.items()}

    def whole(a, b):
        exact = sum(int(x) * int(y) for x, y in zip(np.floor(256 * a), np.floor(256 * b)))
        return min(max(exact, -(2**63)), 2**63 - 1)

    got = {}
    for r in top_k(frame(spark, rows), asked).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got == plain(kept, whole, 5)
    few = [(r.score, r.vec_id) for r in top_k(frame(spark, [(0, [1.0, 1.0]), (1, []), (2, [-1.0, 0.0])]), asked).orderBy("rank").collect()]
    assert few == [(0, 1), (-(256**2), 2)]
