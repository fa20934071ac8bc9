"""Whole batches of texts cut into words with numpy, hashes of the words, and memories of bounded size."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Regex, pre_tokenizers

# Characters that go through numpy at once, and rows that go through Python at once.
CHARS, ROWS = 1 << 19, 512
LETTER, DIGIT, BLANK, OTHER, BETWEEN = range(5)
# Bytes of the longest word whose polynomial hash is kept: on long ones, sums of powers modulo 2 to the 64 cancel out.
SHORT = 32
CONTRACTIONS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = int(_rng.integers(1, 2**62)) * 8 + 5
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2 to the 64."""
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, CHARS + 4096), base & (2**64 - 1), dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name][:n]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, the same wherever the run stands; of long runs a cryptographic one."""
    n = len(data)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power("up", _BASE, n), out=prefix[1:])
    back = _power("down", pow(_BASE, -1, 2**64), n + 1)
    hashes = (prefix[ends] - prefix[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _BYTE[7]
    hashes ^= hashes >> np.uint64(29)
    long = np.flatnonzero(ends - starts > SHORT)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        for i, a, b in zip(long.tolist(), starts[long].tolist(), ends[long].tolist()):
            hashes[i] = int.from_bytes(hashlib.blake2b(raw[a:b], digest_size=8).digest(), "little")
    return hashes


def latin_classes() -> np.ndarray:
    """Letter, digit, white space or other for the first 256 code points, as the tokenizers library sees them."""
    chars = "".join(map(chr, range(256)))
    classes = np.full(256, OTHER, dtype=np.uint8)
    for pattern, number in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", BLANK)):
        for piece, _ in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(chars):
            classes[[ord(c) for c in piece]] = number
    return classes


def latin(text: str) -> bytes | None:
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def segments(text: str, size: int = CHARS) -> Iterator[str]:
    """A text in parts of about ``size``, cut before single spaces between other characters, where words end anyway."""
    start, gap = 0, re.compile(r"(?<=[^\W_]) (?=[^\W_])")
    while len(text) - start > size:
        found = gap.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def cut_words(texts: list[bytes], classes: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Data, starts, ends and text numbers of the words of Latin-1 texts, as two expressions of byte-pair vocabularies cut them.

    ``spaced``: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ ; all characters are
    in some word. Otherwise 's|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+ ; white space is left out.
    """
    data = np.frombuffer(b"\x00".join([*texts, b""]), dtype=np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kind = classes[data]
    kind[text_ends] = BETWEEN
    n = len(data)
    if n == 0:
        empty = np.zeros(0, dtype=np.int64)
        return data, empty, empty, empty
    run = np.empty(n, dtype=bool)  # where a run of one class begins
    run[0] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:])
    begins = run.copy()
    if not spaced:
        begins |= kind == DIGIT
    begins[text_ends] = True
    before = np.empty(n, dtype=np.uint8)
    before[0], before[1:] = BETWEEN, kind[:-1]
    first = np.flatnonzero(run)
    lengths = np.diff(np.append(first, n))
    after_space = np.zeros(n, dtype=bool)
    if spaced:
        solid = first[(kind[first] != BLANK) & (kind[first] != BETWEEN) & (before[first] == BLANK)]
        attached = data[solid - 1] == 0x20
        begins[solid[attached]] = False
        after_space[solid[attached]] = True
        begins[solid - 1] = True  # the last of the white space goes with the run or stands alone
    # A lone apostrophe at a word's start takes the ending that follows it.
    quote = first[(data[first] == 0x27) & (lengths == 1) & (kind[first] == OTHER)]
    quote = quote[~after_space[quote]]
    padded = np.append(data, np.zeros(3, dtype=np.uint8))
    for ending in CONTRACTIONS:
        hit = quote.copy()
        for i, char in enumerate(ending):
            hit = hit[padded[hit + 1 + i] == char]
        if len(hit):
            begins[hit + 1] = False
            rest = hit + 1 + len(ending)
            rest = rest[kind[rest] == LETTER]
            begins[rest] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], n)
    wanted = kind[starts] != BETWEEN
    if not spaced:
        wanted &= kind[starts] != BLANK
    starts, ends = starts[wanted], ends[wanted]
    return data, starts, ends, np.searchsorted(text_ends, starts)


class Memory(dict):
    """What ``make`` gives for a word, for the last ``size`` to twice ``size`` different words, and those of one call.

    When the newer half is full it becomes the older one; a word found there moves on. So frequent words stay.
    ``make_all``, where given, makes the values of many new words in one call.
    """

    def __init__(self, make: Callable, size: int = 200_000, make_all: Callable[[list], list] | None = None):
        super().__init__()
        self.make, self.size, self.make_all, self.older = make, size, make_all, {}

    def all(self, words: list) -> list:
        """The values of different words."""
        values = list(map(self.get, words))
        at = [i for i, value in enumerate(values) if value is None]
        if not at:
            return values
        missed = [words[i] for i in at]
        found = list(map(self.older.get, missed))
        new = [word for word, value in zip(missed, found) if value is None]
        made = iter(self.make_all(new) if self.make_all else map(self.make, new))
        found = [next(made) if value is None else value for value in found]
        self._make_room()
        self.update(zip(missed, found))
        for i, value in zip(at, found):
            values[i] = value
        return values

    def _make_room(self) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()

    def __missing__(self, word):
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
        self._make_room()
        self[word] = value
        return value


def _one_of_each(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where some occurrence of each different hash stands, and for each hash the number of its value.

    ``np.unique`` looks for the first occurrence, which takes a slower, stable sort.
    """
    order = np.argsort(hashes)
    ranked = hashes[order]
    new = np.empty(len(hashes), dtype=bool)
    new[:1] = True
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    which = np.empty(len(hashes), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def word_ids(texts: list[bytes], classes: np.ndarray, spaced: bool, memory: Memory) -> list[np.ndarray]:
    """The ids of each Latin-1 text; ``memory`` gives those of a word as bytes. Equal words are looked up once."""
    data, starts, ends, owner = cut_words(texts, classes, spaced)
    if not len(starts):
        return [np.zeros(0, dtype="<i4") for _ in texts]
    firsts, which = _one_of_each(run_hashes(data, starts, ends))
    raw = data.tobytes()
    found = memory.all([raw[a:b] for a, b in zip(starts[firsts].tolist(), ends[firsts].tolist())])
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
    values = np.frombuffer(b"".join(found), dtype="<i4")
    offsets = np.cumsum(sizes) - sizes
    counts = sizes[which]
    stops = np.cumsum(counts)
    ids = values[np.arange(stops[-1]) + np.repeat(offsets[which] - (stops - counts), counts)]
    bounds = np.append(0, stops)[np.searchsorted(owner, np.arange(len(texts) + 1))]
    return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def encode_all(texts: list[str], plain: Callable[[list[bytes]], list[np.ndarray]], other: Callable[[str], np.ndarray]) -> list[np.ndarray]:
    """Ids of each text: Latin-1 texts together in parts of bounded size by ``plain``, the others one by one.

    Whether a text is Latin-1 only decides which of two ways to the same ids is taken.
    """
    found: list = [None] * len(texts)
    group, at, size = [], [], 0

    def flush() -> None:
        if not group:
            return
        for i, ids in zip(at, plain(group)):
            found[i].append(ids)
        group.clear()
        at.clear()

    for i, text in enumerate(texts):
        found[i] = []
        for part in segments(text):
            data = latin(part)
            if data is None:
                if at and at[-1] == i:
                    flush()
                found[i].append(other(part))
                continue
            group.append(data)
            at.append(i)
            size += len(data)
            if size > CHARS:
                flush()
                size = 0
    flush()
    return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, dtype="<i4") for x in found]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def added_tokens(tokenizer) -> dict[str, int]:
    """Tokens that the library cuts out of a text before anything else."""
    return {token.content: number for number, token in tokenizer.get_added_tokens_decoder().items()}


def any_of(contents) -> re.Pattern:
    """An expression that captures the longest of the given strings."""
    return re.compile("(" + "|".join(re.escape(c) for c in sorted(contents, key=len, reverse=True)) + ")")
