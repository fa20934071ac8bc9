"""Packing, joins, sharding and classifiers against plain computations."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docloom.llm import ngram_join as near_join, quality, toxicity
from docloom.llm.components import components
from docloom.llm.ngram_join import ngram_join
from docloom.llm.packing import best_fit, best_pattern, pack, plan
from docloom.llm.sharding import assign_shards, rendezvous, write_shards
from tests.llm.helpers import edge_rows, frame

SF_DIR = "/root/testdata/sf0.01"
LOWER = {c: c + 32 for c in range(65, 91)}


# Packing


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing(spark, capacity):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [*edge_rows(), (200, "a <|endoftext|> b"), (201, "  two  spaces\n\n'sand don't ")]
    found = pack(frame(spark, rows), path, capacity=capacity).toPandas()
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group.offset.tolist() == [0, *group.length.cumsum()[:-1]] and group.length.sum() <= capacity
    wanted = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted.append((-1 if i is None else i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    found["doc_id"] = found.doc_id.fillna(-1).astype(int)
    got = [tuple(map(int, r)) for r in found[["doc_id", "piece", "start", "length", "ids_crc32"]].to_numpy()]
    assert sorted(got) == sorted(wanted)
    assert found.sequence_id.nunique() <= 1.05 * found.length.sum() / capacity + 2
    assert pack(frame(spark, []), path).count() == 0


def test_pattern_is_the_best():
    rng = np.random.default_rng(1)
    for _ in range(20):
        values = np.where(rng.random(12) < 0.6, rng.random(12), 0.0)
        best = max(
            sum(values[s - 1] for s in chosen) for n in range(13)
            for chosen in itertools.combinations_with_replacement(range(1, 13), n) if n <= 4 and sum(chosen) <= 12
        )
        value, pattern = best_pattern(values, 12)
        assert pattern @ np.arange(13) <= 12
        assert abs(value - sum(pattern[s] * values[s - 1] for s in range(1, 13))) < 1e-9 and value >= best - 1e-9


def plain_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        at = min(fits, key=lambda i: rooms[i]) if fits else len(rooms)
        rooms[at : at + 1] = [(rooms[at] if fits else capacity) - length]
    return len(rooms)


def test_plan_covers_exactly_and_nears_the_bound():
    rng = np.random.default_rng(3)
    for n in (0, 3, 500, 20_000):
        lengths = np.clip(rng.lognormal(4, 1, n), 1, 128).astype(int)
        demand = np.bincount(lengths, minlength=129)
        made, bound = plan(demand, 128)
        assert (sum((p * k for p, k in made), np.zeros(129, dtype=int)) == demand).all()
        assert all(p @ np.arange(129) <= 128 for p, _ in made)
        used = sum(k for _, k in made)
        assert bound - 1e-6 <= used <= 1.02 * bound + 2
        if n <= 500:
            assert sum(k for _, k in best_fit(demand)) == plain_best_fit(lengths, 128)


# N-gram join


def plain_join(rows, n, percent):
    def grams(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()

    sets = [(2**63 - 1 if i is None else i, grams(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            low, high = sorted((root(i), root(j)))
            parent[high] = low
    back = lambda i: None if i == 2**63 - 1 else i
    return sorted(((back(i), len(g), back(root(i))) for i, g in sets), key=repr)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(spark, n, percent):
    rnd = np.random.default_rng(4)
    base = [f"w{k}" for k in rnd.integers(0, 50_000, 300)]
    rows = edge_rows()
    for i in range(60):  # near copies of one text, with chains and misses
        words = [*base]
        for at in rnd.integers(0, 300, rnd.integers(0, 9)):
            words[at] = f"e{rnd.integers(0, 40)}"
        rows.append((1000 + i, " ".join(words)))
    passage = " ".join(f"p{k}" for k in range(30))
    rows += [(2000 + i, passage + " " + " ".join(f"q{k}" for k in rnd.integers(0, 9999, 60))) for i in range(40)]
    found = ngram_join(frame(spark, rows), n=n, percent=percent).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr)
    assert got == plain_join(rows, n, percent)
    assert ngram_join(frame(spark, [])).count() == 0


def test_near_copies_meet_the_text_they_were_made_from(spark, monkeypatch):
    """Copies with two changes each are similar to their text, and not to each other: they must not all be paired."""
    rnd = np.random.default_rng(8)
    base = [f"w{k}" for k in rnd.integers(0, 90_000, 182)]
    rows = [(500, " ".join(base))]
    for i in range(120):
        words = [*base]
        for k, at in enumerate(rnd.choice(np.arange(5, 175, 10), 2, replace=False)):
            words[at] = f"own{i}x{k}"
        rows.append((i, " ".join(words)))
    made, plain = [], near_join._cross_pairs

    def counted(*args):
        pairs = plain(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_join, "_cross_pairs", counted)
    found = near_join.ngram_join(frame(spark, rows), n=3, percent=90).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 121
    assert len(made) == 1 and made[0] <= 121


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(200 + i, 200) for i in range(1, 50)] + [(300, 300)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert Counter(r.comp for r in found) == {1: 60, 200: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Sharding


def test_sharding(spark, tmp_path):
    rows = edge_rows() + [(5000 + i, "same") for i in range(3000)]
    even = dict.fromkeys(range(8), 1.0)
    found = assign_shards(frame(spark, rows), even, even | {8: 1.0}).toPandas()
    assert len(found) == len(rows)
    for _, group in found.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))
    moved = found[found["shard"] != found.grown_shard]
    assert (moved.grown_shard == 8).all() and 0.05 < len(moved) / len(found) < 0.2
    sizes = Counter((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows)
    assert Counter(zip(found["size"], found.text_crc32)) == sizes
    assert found.groupby(found.doc_id.fillna(-1))["shard"].nunique().max() == 1
    assert assign_shards(frame(spark, []), even).count() == 0
    with pytest.raises(ValueError, match="weight"):
        assign_shards(frame(spark, []), {0: 0.0})
    write_shards(frame(spark, rows), even, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows)
    assert dict(back.groupBy("_shard").count().collect()) == found["shard"].value_counts().to_dict()


def test_rendezvous_weights():
    keys = np.random.default_rng(0).integers(0, 2**63, 40_000).astype(np.uint64)
    before, after = rendezvous(keys, {0: 1.0, 1: 1.0, 2: 2.0, 3: 0.0}), rendezvous(keys, {0: 1.0, 1: 1.0, 2: 3.0, 3: 0.0})
    assert np.allclose(np.bincount(before, minlength=4) / len(keys), [0.25, 0.25, 0.5, 0], atol=0.01)
    assert (after[before != after] == 2).all()


# Classifiers


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def held_out_accuracy(scored, labels, label):
    rows = scored.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).join(labels, "doc_id")
    return rows.select("score", F.col(label).alias("y")).toPandas()


def test_quality(spark, documents):
    docs, labels = documents
    model = quality.train_quality(docs, labels)
    found = held_out_accuracy(quality.score_quality(docs, model), labels, "quality")
    assert ((found.score >= 0.7) == (found.y == 1)).mean() > 0.95
    scored = quality.score_quality(frame(spark, edge_rows()), model).collect()
    assert len(scored) == len(edge_rows()) and all(0 <= r.score <= 1 for r in scored)
    assert quality.score_quality(frame(spark, []), model).count() == 0
    assert quality.train([], []) == 1.0 and quality.train(["a"], [0]) == 0.0
    assert {r.score for r in quality.score_quality(frame(spark, [(1, None), (2, "b")]), 1.0).collect()} == {1.0}


def test_quality_reads_the_end_of_a_text_and_does_not_depend_on_neighbours(documents):
    docs, labels = documents
    model = quality.train_quality(docs, labels)
    good = " ".join(r.text for r in docs.join(labels.filter("quality = 1"), "doc_id").limit(40).collect()).encode()
    junk = b"BUY!! NOW!! " * 400
    alone = model.score([good, good + junk, junk])
    assert alone[1] < alone[0] and alone[2] < 0.5
    together = model.score([junk, b"", good, b"x", good + junk])
    assert np.allclose(together[[2, 4, 0]], alone, atol=1e-5)


def test_quality_gradients():
    rng = np.random.default_rng(1)
    net = quality.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = [bytes(rng.integers(97, 105, n).tolist()) for n in (3, 70, 200)]
    batch, wanted = quality.Batch(texts), np.array([1.0, 0.0, 1.0])

    def loss():
        s = net.forward(batch)["score"]
        return -np.mean(wanted * np.log(s) + (1 - wanted) * np.log(1 - s))

    grads = net.gradients(batch, wanted)
    for name in ("near", "chunk", "out"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        net.p[name][at] += 1e-3
        up = loss()
        net.p[name][at] -= 2e-3
        down = loss()
        net.p[name][at] += 1e-3
        assert abs((up - down) / 2e-3 - grads[name][at]) < 0.05 * abs(grads[name][at]) + 1e-4


def test_toxicity(spark, documents):
    docs, labels = documents
    model = toxicity.train_toxicity(docs, labels)
    found = held_out_accuracy(toxicity.score_toxicity(docs, model), labels, "toxic")
    # The table has two dozen toxic texts to learn from, in four languages.
    assert ((found.score >= 0.3) == (found.y == 1)).mean() > 0.92
    assert ((found.score >= 0.3) & (found.y == 0)).mean() < 0.02
    scored = toxicity.score_toxicity(frame(spark, edge_rows()), model).collect()
    assert len(scored) == len(edge_rows()) and all(0 <= r.score < 0.3 for r in scored)
    assert toxicity.score_toxicity(frame(spark, []), model).count() == 0
    assert toxicity.train([], []).score([b"a", b""]).max() < 0.01


def test_toxicity_reads_long_texts_whole():
    rng = np.random.default_rng(5)
    clean = [" ".join(f"w{k}" for k in rng.integers(0, 400, 50)) for _ in range(300)]
    toxic = [f"{t} {rng.choice(['blarg', 'snorf', 'grumplefoo'])} {rng.choice(['blarg', 'snorf'])}" for t in clean[:100]]
    model = toxicity.train(toxic + clean[100:], [1] * 100 + [0] * 200)
    long = ("harmless " * 700_000).encode()
    scores = model.score([long, long + b"blarg", b"blarg", b"word"])
    assert scores[0] < 0.3 <= scores[1] and scores[2] >= 0.3 > scores[3]


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(6)
    truth = rng.random(4000) < 0.4
    right = lambda p: np.where(rng.random(4000) < p, np.where(truth, 1, -1), np.where(truth, -1, 1))
    votes = np.column_stack([right(p) for p in (0.9, 0.8, 0.8, 0.75, 0.75, 0.7)])
    votes = np.column_stack([votes, votes[:, 5], np.zeros(4000, dtype=int)])
    model = toxicity.LabelModel(votes, 0.4)
    assert (np.abs(model.accuracies[:7] - [0.9, 0.8, 0.8, 0.75, 0.75, 0.7, 0.7]) < 0.1).all()
    assert max(model.share[[5, 6]]) < 0.6 < min(model.share[:5])
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.88


def test_rows_without_an_id_or_with_one_id_join_no_others(spark):
    """Near copies of two unrelated documents under no id, and others under one id."""
    rnd = np.random.default_rng(11)
    text = lambda: " ".join(f"w{k}" for k in rnd.integers(0, 90_000, 100))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(10, a), (20, b), (30, c), (40, d), (None, a + " x"), (None, b + " y"), (50, c + " x"), (50, d + " y"), (None, e), (None, e + " z")]
    found = ngram_join(frame(spark, rows)).collect()
    got = sorted(((r.doc_id, r.component_id) for r in found), key=repr)
    assert got == sorted(
        [(10, 10), (20, 20), (30, 30), (40, 40), (None, 10), (None, 20), (50, 30), (50, 40), (None, None), (None, None)], key=repr
    )
