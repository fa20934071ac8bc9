"""Byte-pair encoding and decoding with a given vocabulary of word ends.

A word's parts stand in one array, beside the ranks of adjacent pairs. The smallest rank is found by a scan, its
boundary is deleted, and the ranks at both sides are looked up anew. Words repeat, so their ids are remembered.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, pre_tokenizers

from docloom.llm.words import Memory, added_tokens, any_of, encode_all, latin_classes, small_batches, word_ids

NONE = 2**31
# Longer words are merged with a heap, which gives the same parts without the square of their length.
SHORT = 400
# Fixed value: the expression that this form of file splits at.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next free one from 256."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class WordBpe:
    """Encodes and decodes as the tokenizers library does with a file of this form.

    The form is: NFC, white space to one space, lower case; words split by an expression; byte characters; pairs
    merged by rank within a word whose last part carries an end mark. Other forms are refused.
    """

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        form = (steps, split["pattern"]["Regex"], level["type"], level["use_regex"], spec["decoder"])
        if form != (["NFC", "Replace", "Lowercase"], SPLIT, "ByteLevel", False, None):
            raise ValueError("this vocabulary file is of another form")
        self.normalizer = library.normalizer
        self.split = pre_tokenizers.Split(Regex(SPLIT), "removed", invert=True)
        self.classes = latin_classes()
        # NFC changes no Latin-1 character, and lower case stays within Latin-1.
        self.lower = bytes(ord(chr(i).lower()) for i in range(256))
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        chars = _byte_chars()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + end] for c in chars]
        self.base = 1 << max(vocab.values()).bit_length()
        self.ranks, self.made = {}, []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks.setdefault(vocab[left] * self.base + vocab[right], rank)
            self.made.append(vocab[left + right])
        self.added = added_tokens(library)
        self.cut = any_of(self.added)
        self.tokens = {number: token for token, number in vocab.items()} | {n: c for c, n in self.added.items()}
        self.memory = Memory(self._word_ids)

    def merge(self, parts: list[int]) -> list[int]:
        """The parts of one word after all merges, smallest rank first and leftmost among equals."""
        if len(parts) > SHORT:
            return self._merge_long(parts)
        rank_of, base, made = self.ranks.get, self.base, self.made
        ranks = [rank_of(a * base + b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            smallest = min(ranks)
            if smallest == NONE:
                break
            i = ranks.index(smallest)
            parts[i] = made[smallest]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] * base + parts[i], NONE)
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] * base + parts[i + 1], NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        rank_of, base = self.ranks.get, self.base
        after, before = [*range(1, len(parts) + 1)], [*range(-1, len(parts) - 1)]
        heap = [(r, i) for i in range(len(parts) - 1) if (r := rank_of(parts[i] * base + parts[i + 1], NONE)) < NONE]
        heapq.heapify(heap)
        end = len(parts)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else end
            if j == end or rank_of(parts[i] * base + parts[j], NONE) != rank:
                continue
            parts[i], parts[j] = self.made[rank], -1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < end and (r := rank_of(parts[a] * base + parts[b], NONE)) < NONE:
                    heapq.heappush(heap, (r, a))
        return [p for p in parts if p >= 0]

    def _word_ids(self, word: bytes) -> bytes:
        data = word if word.isascii() else word.decode("latin-1").encode()
        return self._data_ids(data)

    def _data_ids(self, data: bytes) -> bytes:
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        return np.array(self.merge(parts), dtype="<i4").tobytes()

    def _latin_ids(self, texts: list[bytes]) -> list[np.ndarray]:
        return word_ids([t.translate(self.lower) for t in texts], self.classes, False, self.memory)

    def _other_ids(self, text: str) -> np.ndarray:
        words = self.split.pre_tokenize_str(self.normalizer.normalize_str(text))
        return np.frombuffer(b"".join([self._data_ids(w.encode()) for w, _ in words]), dtype="<i4")

    def _cut_ids(self, text: str) -> np.ndarray:
        """Ids of a text that holds added tokens."""
        parts = self.cut.split(text)
        return np.concatenate([
            np.array([self.added[part]], dtype="<i4") if i % 2 else self.encode([part])[0] for i, part in enumerate(parts)
        ])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        marked = [i for i, text in enumerate(texts) if self.cut.search(text)]
        plain = [*texts]
        for i in marked:
            plain[i] = ""
        found = encode_all(plain, self._latin_ids, self._other_ids)
        for i in marked:
            found[i] = self._cut_ids(texts[i])
        return found

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, as the library does for a file without a decoder; unknown ids are left out."""
        tokens = self.tokens
        try:
            return " ".join([tokens[i] for i in ids])
        except KeyError:
            return " ".join([tokens[i] for i in ids if i in tokens])


# Once for each worker process: building the classes and ranks takes a second, and remembered words serve later tasks.
@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode_bpe(documents: DataFrame, path: str, text_col: str = "text", decode: bool = False) -> DataFrame:
    """The columns of ``documents`` but the text, with ``ids`` and, if asked for, ``decoded`` (its tokens as text).

    Null text counts as empty and has no ids. Whole texts are encoded, of any length. Rows are looked at one by one,
    so repeated rows and other columns change nothing; there is no shuffle.
    """
    kept = [c for c in documents.columns if c != text_col]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_bpe(path)
        for batch in small_batches(batches):
            ids = model.encode([t or "" for t in batch.column(len(kept)).to_pylist()])
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            values = pa.array(np.concatenate(ids) if ids else np.zeros(0, dtype="<i4"), pa.int32())
            columns = [*batch.columns[: len(kept)], pa.ListArray.from_arrays(pa.array(ends), values)]
            if decode:
                columns.append(pa.array([model.decode(x.tolist()) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "ids"] + ["decoded"] * decode)

    fields = "".join(f"`{c}` {documents.schema[c].dataType.simpleString()}, " for c in kept)
    return documents.select(*kept, text_col).mapInArrow(encoded, f"{fields}ids array<int>" + ", decoded string" * decode)


def decode_bpe(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """All columns and ``decoded``; null ids decode to the empty text."""
    names = encoded.columns

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_bpe(path)
        for batch in small_batches(batches):
            texts = [model.decode(x or []) for x in batch.column(names.index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decoded, f"{fields}, decoded string")
