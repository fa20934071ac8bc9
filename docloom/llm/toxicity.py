"""Toxicity by weak supervision.

Many voters look at a text: lexicons of words, and patterns of how words begin. A generative label model
estimates from their votes how accurate each voter is and which voters repeat each other, and turns the votes into
posterior labels. A linear classifier learns from those and scores all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.ngram_join import ngram_sets
from docloom.llm.shared import labelled_sample
from docloom.llm.words import run_hashes, small_batches

# Rows to learn from: of toxic and of clean ones, at most, and the longest text among them, in characters.
TOXIC, CLEAN, LONGEST = 2000, 10_000, 20_000
# Features of a word: itself, and its first bytes, so many of them.
STARTS = (4, 5, 6)
# Voters of each kind, the toxic texts that an entry needs (a part of all, between two numbers), and how much of its
# mass must be in toxic texts.
VOTERS, SEEN_PART, SEEN_LEAST, SEEN_MOST, PURE = 6, 0.02, 3, 10, 0.95
# No posterior label is lower than this, so that one entry alone can carry a text over the threshold.
SURE = 0.02
# Features of the linear classifier at most, the log odds that one needs, and the steps, rate and decay of learning.
FEATURES, TELLING, PASSES, RATE, DECAY = 4096, 3.5, 500, 0.1, 1e-4
PART_BYTES = 1 << 20

_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
# Letters of the Latin-1 supplement are two bytes in UTF-8; their capitals differ in the second one only.
_word = np.zeros(256, dtype=bool)
_word[97:123] = True
_word[128:] = True


def text_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and feature hashes of all words; words are runs of letters, A-Z in lower case."""
    data = _fold[np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)]
    after = np.append(False, data[:-1] == 0xC3)
    data = np.where(after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97), data + 32, data).astype(np.uint8)
    edge = np.diff(np.concatenate([[False], _word[data], [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    owners, found = [owner], [run_hashes(data, starts, ends)]
    for size in STARTS:
        long = ends - starts > size
        owners.append(owner[long])
        found.append(run_hashes(data, starts[long], starts[long] + size) ^ np.uint64(0x51ED270B35A1F4C5 + size))
    return np.concatenate(owners), np.concatenate(found)


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts of a few megabytes, cut where no word is."""
    start = 0
    while len(text) - start > PART_BYTES:
        end = start + PART_BYTES
        while end < len(text) and _word[_fold[text[end]]]:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def matched(texts: list[bytes], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (text number, place in ``known``) of the features that are in ``known``, which is sorted."""
    rows, places = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    marks = np.zeros(1 << 16, dtype=bool)
    marks[(known & np.uint64(0xFFFF)).astype(np.int64)] = True

    def look(group: list[bytes], numbers: list[int]) -> None:
        owner, found = text_features(group)
        may = marks[(found & np.uint64(0xFFFF)).astype(np.int64)]
        owner, found = owner[may], found[may]
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        hit = known[at] == found
        rows.append(np.array(numbers, dtype=np.int64)[owner[hit]])
        places.append(at[hit])

    group, numbers, size = [], [], 0
    for i, text in enumerate(texts):
        for part in _parts(text) if len(known) else ():
            group.append(part)
            numbers.append(i)
            size += len(part)
            if size > PART_BYTES // 2:
                look(group, numbers)
                group, numbers, size = [], [], 0
    if group:
        look(group, numbers)
    pairs = np.unique(np.concatenate(rows) * max(1, len(known)) + np.concatenate(places))
    return pairs // max(1, len(known)), pairs % max(1, len(known))


class LabelModel:
    """How voters vote (1, -1 or 0 for no opinion) given the class that nobody sees. No opinion is no evidence.

    Expectation maximisation finds each voter's rates in both classes and with them its accuracy. What is left of the
    agreement of two voters once the class is known is their correlation; a voter's evidence is divided by how many
    voters, itself included, it repeats.
    """

    def __init__(self, votes: np.ndarray, prior: float, rounds: int = 30):
        self.prior = prior
        stacked = np.stack([votes == v for v in (-1, 0, 1)])  # vote, text, voter
        positive = np.clip(prior + 0.4 * (votes.sum(axis=1) > 0) - 0.4 * (votes.sum(axis=1) < 0), 0.02, 0.98)
        self.share = np.ones(votes.shape[1])
        for number in range(rounds):
            weight = np.stack([1 - positive, positive])  # class, text
            self.rates = (np.einsum("ct,vtm->cvm", weight, stacked) + 0.5) / (weight.sum(axis=1)[:, None, None] + 1.5)
            if number % 10 == 9:
                self.correlations = self._correlations(votes, positive)
                self.share = 1 / np.maximum(1, np.clip(self.correlations, 0, None).sum(axis=1))
            positive = self.posterior(votes)
        self.accuracies = (self.rates[1, 2] * prior + self.rates[0, 0] * (1 - prior)) / (
            (self.rates[1, 2] + self.rates[1, 0]) * prior + (self.rates[0, 0] + self.rates[0, 2]) * (1 - prior)
        )

    def _correlations(self, votes: np.ndarray, positive: np.ndarray) -> np.ndarray:
        expected = np.stack([self.rates[c, 2] - self.rates[c, 0] for c in (0, 1)])
        rest = votes - (1 - positive)[:, None] * expected[0] - positive[:, None] * expected[1]
        spread = np.sqrt((rest**2).mean(axis=0)) + 1e-9
        return (rest.T @ rest) / len(votes) / np.outer(spread, spread)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        evidence = np.log(self.rates[1]) - np.log(self.rates[0])  # vote, voter
        total = sum((votes == v) @ (evidence[i] * self.share) for i, v in ((0, -1), (2, 1)))
        odds = np.clip(total + np.log(self.prior / (1 - self.prior)), -30, 30)
        return 1 / (1 + np.exp(-odds))


@dataclass
class Classifier:
    """Sorted feature hashes, their weights, and the intercept; no features give one score for all texts."""

    known: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        rows, places = matched(texts, self.known)
        total = np.bincount(rows, self.weights[places] if len(places) else None, len(texts)).astype(float)
        return 1 / (1 + np.exp(-np.clip(total + self.intercept, -30, 30)))


def _voters(entries: np.ndarray, strength: np.ndarray) -> list[np.ndarray]:
    """Entries dealt out by strength, so that each voter knows strong and weak ones."""
    ordered = entries[np.argsort(-strength, kind="stable")]
    return [ordered[i::VOTERS] for i in range(VOTERS) if len(ordered[i::VOTERS])]


def train(texts: list[str], labels: list[int]) -> Classifier:
    """Voters from the labelled texts, posterior labels from their votes, and weights from those.

    A word or pattern is an entry of some voter if enough toxic texts hold it and nearly all of its mass is
    in toxic texts. A voter says toxic if it meets an entry and
    nothing otherwise; two more voters say clean where no lexicon, or no pattern, has met any.
    """
    data, wanted = _without_copies([t.encode() for t in texts], labels)
    nothing = np.zeros(0, dtype=np.uint64)
    if not wanted.any() or wanted.all():
        return Classifier(nothing, np.zeros(0), 30.0 if len(wanted) and wanted.all() else -30.0)
    rows, found, is_word = _distinct_features(data)
    features, columns = np.unique(found, return_inverse=True)
    held = wanted[rows]
    toxic = np.bincount(columns[held], minlength=len(features))
    clean = np.bincount(columns[~held], minlength=len(features))
    rate_toxic, rate_clean = (toxic + 0.1) / wanted.sum(), (clean + 0.1) / (~wanted).sum()
    pure = rate_toxic / (rate_toxic + rate_clean)
    words = np.zeros(len(features), dtype=bool)
    words[columns[is_word]] = True
    seen = min(SEEN_MOST, max(SEEN_LEAST, SEEN_PART * wanted.sum()))
    listed = (toxic >= seen) & (pure >= PURE)
    lexicons = _voters(np.flatnonzero(listed & words), toxic[listed & words])
    patterns = _voters(np.flatnonzero(listed & ~words), toxic[listed & ~words])
    votes = np.zeros((len(data), len(lexicons) + len(patterns)), dtype=np.int64)
    for i, entries in enumerate(lexicons + patterns):
        votes[rows[np.isin(columns, entries)], i] = 1
    quiet = [-1 * (group.sum(axis=1) == 0) for group in np.split(votes, [len(lexicons)], axis=1) if group.shape[1]]
    votes = np.column_stack([votes, *quiet])
    if not votes.shape[1]:
        return Classifier(nothing, np.zeros(0), float(np.log(wanted.mean() / (1 - wanted.mean()))))
    target = np.maximum(LabelModel(votes, float(wanted.mean())).posterior(votes), SURE)
    # The linear classifier sees the features that are most telling under the posterior labels.
    mass = np.bincount(columns, target[rows], len(features))
    every = np.bincount(columns, minlength=len(features))
    pull = np.log((mass + 0.5) / (target.sum() + 1)) - np.log((every - mass + 0.5) / ((1 - target).sum() + 1))
    telling = np.where((every >= seen) & (pull >= TELLING), pull * np.sqrt(every), 0)
    used = np.sort(np.argsort(-telling, kind="stable")[: min(FEATURES, int((telling > 0).sum()))])
    place = np.full(len(features), -1)
    place[used] = np.arange(len(used))
    kept = place[columns] >= 0
    r, c = rows[kept], place[columns[kept]]
    weights = np.zeros(len(used) + 1)  # the last is the intercept
    weights[-1] = np.log(target.mean() / (1 - target.mean()))
    first, second = np.zeros(len(weights)), np.zeros(len(weights))
    for step in range(1, PASSES + 1):
        logit = np.clip(np.bincount(r, weights[c], len(data)) + weights[-1], -30, 30)
        miss = (1 / (1 + np.exp(-logit)) - target) / len(data)
        slope = np.append(np.bincount(c, miss[r], len(used)) + DECAY / max(1, len(used)) * weights[:-1], miss.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        weights -= RATE * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Classifier(features[used], weights[:-1], float(weights[-1]))


def _without_copies(data: list[bytes], labels: list[int]) -> tuple[list[bytes], np.ndarray]:
    """One text of those with a label and the same smallest hash of three words, which most copies share.

    A family of copies would else make each of its words look telling.
    """
    firsts: dict = {}
    for at in range(0, len(data), 64):
        group = data[at : at + 64]
        for i, found in enumerate(ngram_sets(group, 3), start=at):
            firsts.setdefault((labels[i], int(found[0]) if len(found) else -1), i)
    return [data[i] for i in firsts.values()], np.array([labels[i] for i in firsts.values()], dtype=bool)


def _distinct_features(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of text number and feature, and whether the feature is a whole word; texts go in small groups."""
    rows, found, words = [], [], []
    for at in range(0, len(data), 64):
        group = data[at : at + 64]
        owner, hashes = text_features(group)
        features, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        pairs = np.unique(owner * len(features) + which)
        rows.append(at + pairs // len(features))
        found.append(features[pairs % len(features)])
        words.append((first < _count_words(group))[pairs % len(features)])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(words)


def _count_words(data: list[bytes]) -> int:
    """How many of the features that ``text_features`` gives are whole words; these come first."""
    joined = _word[_fold[np.frombuffer(b" ".join([*data, b""]), dtype=np.uint8)]]
    return int((joined & ~np.append(False, joined[:-1])).sum())


def train_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> Classifier:
    return train(*labelled_sample(documents, labels, label, {1: TOXIC, 0: CLEAN}, LONGEST))


def score_toxicity(documents: DataFrame, model: Classifier, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns and ``score_col``, the probability that a text is toxic. The whole text is read, however long.

    Null counts as the empty text, which gets a score like any other. Rows are scored one by one: repeated rows get
    the same score, other columns are never looked at. There is no shuffle.
    """
    names = documents.columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for batch in small_batches(batches):
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            scores = np.round(model.score(texts), 6) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(scored, f"{fields}, `{score_col}` double")
