"""Best-fit packing of tokenised documents into sequences of one capacity.

The lengths of all pieces make a histogram. Its configuration linear program (patterns of lengths that fill one
sequence, as few sequences as cover the histogram) is solved by multiplicative weights; a knapsack dynamic program
prices each next pattern. Whole parts of the solution are kept, what is left is packed best-fit, and every piece finds
its sequence by its rank among the pieces of its length.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from docloom.llm.shared import class_ranks, unsigned_crc
from docloom.llm.words import Memory, added_tokens, any_of, encode_all, latin_classes, small_batches, word_ids
from docloom.session import stage

# The most steps, the part of a length's pieces that one step may cover, and the rate at which covered lengths lose weight.
STEPS, SHARE, RATE = 2500, 0.25, 4.0
# Parts of the solution's uses that rounding tries to keep.
PARTS = (1.0, 0.95, 0.85, 0.7, 0.5)


class ByteBpe:
    """Ids as the tokenizers library gives them for a byte-level file; it is asked once for each word it is given."""

    def __init__(self, path: str):
        # A task has one core, also for words that are encoded together.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.classes = latin_classes()
        # Padding would be to the longest word of a call.
        self.memory = Memory(self._word_ids, make_all=self._all_word_ids if self.library.padding is None else None)
        added = added_tokens(self.library)
        self.cut = any_of(added) if added else None

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<i4")

    def _word_ids(self, word: bytes) -> bytes:
        return self._ids(word.decode("latin-1")).tobytes()

    def _all_word_ids(self, words: list[bytes]) -> list[bytes]:
        found = self.library.encode_batch_fast([w.decode("latin-1") for w in words], add_special_tokens=False)
        ids = [e.ids for e in found]
        data = np.fromiter(chain.from_iterable(ids), dtype="<i4").tobytes()
        ends = np.cumsum([0, *map(len, ids)]) * 4
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        marked = [i for i, text in enumerate(texts) if self.cut and self.cut.search(text)]
        plain = [*texts]
        for i in marked:
            plain[i] = ""
        found = encode_all(plain, lambda group: word_ids(group, self.classes, True, self.memory), self._ids)
        for i in marked:
            found[i] = self._ids(texts[i])
        return found


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of lengths within ``capacity`` of the largest total value; ``values[s - 1]`` is that of length s."""
    best, chosen = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        total = values[:room] + best[room - 1 :: -1]
        pick = int(total.argmax())
        if total[pick] > best[room - 1] + 1e-15:
            best[room], chosen[room] = total[pick], pick + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(capacity + 1, dtype=np.int64), capacity
    while room > 0:
        if chosen[room]:
            pattern[chosen[room]] += 1
            room -= chosen[room]
        else:
            room -= 1
    return float(best[capacity]), pattern


def solve(demand: np.ndarray, steps: int = STEPS, share: float = SHARE, rate: float = RATE) -> tuple[dict[bytes, float], float]:
    """Patterns (as bytes) with the fraction of sequences that each is used for, and a lower bound of all sequences.

    ``demand[s]`` pieces of length s. Each step prices a pattern by weights that began in proportion to length, and
    uses it until it has covered ``share`` of one of its lengths. The weight of a length then falls, exponentially,
    with how far it is ahead of all pieces together. Any weights bound the optimum from below: their total over all
    pieces, divided by the value of the best pattern.
    """
    capacity = len(demand) - 1
    lengths = np.arange(capacity + 1)
    weight = (lengths * demand).astype(float)
    total, left = weight.sum(), demand.astype(float)
    uses: dict[bytes, float] = {}
    bound = 0.0
    for _ in range(steps):
        open_ = left > 1e-9
        progress = 1 - (lengths * left).sum() / total if total else 1.0
        if progress > 0.999:
            break
        ahead = 1 - np.divide(left, demand, out=np.zeros(capacity + 1), where=open_) - progress
        price = np.where(open_, lengths * np.exp(-rate * ahead), 0.0) / capacity
        value, pattern = best_pattern(price[1:], capacity)
        bound = max(bound, float((price * demand).sum()) / value)
        held = pattern > 0
        times = min((left[held] / pattern[held]).min(), max(1.0, share * (demand[held] / pattern[held]).min()))
        key = pattern.astype("<i8").tobytes()
        uses[key] = uses.get(key, 0.0) + float(times)
        left = np.maximum(left - pattern * times, 0.0)
    return uses, bound


def best_fit(left: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Best-fit decreasing over a histogram: patterns and how often each is used.

    Equal sequences stay together as one group with a count, so the work depends on the capacity, not on the pieces.
    A piece goes where the least room is left that still takes it; that room then takes as many more of the same
    length as it can, since it stays the tightest.
    """
    capacity = len(left) - 1
    rooms: list[list[tuple[list, int]]] = [[] for _ in range(capacity + 1)]
    done: list[tuple[list, int]] = []

    def put(held: list, room: int, count: int) -> None:
        (rooms[room] if room else done).append((held, count))

    for length in range(capacity, 0, -1):
        n, room = int(left[length]), length
        while n:
            while room < capacity and not rooms[room]:
                room += 1
            held, count = rooms[room].pop() if rooms[room] else ([], n)
            each = room // length
            if n < each:
                each, filled = n, 1
            else:
                filled = min(count, n // each)
            if held and count > filled:
                put(held, room, count - filled)
            put([*held, (length, each)], room - length * each, filled)
            n -= each * filled
    patterns = []
    for held, count in done + [group for groups in rooms for group in groups]:
        pattern = np.zeros(capacity + 1, dtype=np.int64)
        for length, each in held:
            pattern[length] += each
        patterns.append((pattern, count))
    return patterns


def plan(demand: np.ndarray, capacity: int) -> tuple[list[tuple[np.ndarray, int]], float]:
    """Patterns with whole numbers of uses that cover ``demand`` exactly, and a lower bound of their number.

    Uses are rounded down, all of them or a part, whichever leaves the better rest for best-fit. The size of the
    result depends on the capacity and the number of steps, not on the number of pieces.
    """
    left = demand.copy()
    full = np.zeros(capacity + 1, dtype=np.int64)
    full[capacity] = 1
    made = [(full, int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    uses, bound = solve(left)
    best: list[tuple[np.ndarray, int]] | None = None
    for part in PARTS:
        rest, taken = left.copy(), []
        for key, share in uses.items():
            pattern = np.frombuffer(key, dtype="<i8")
            held = pattern > 0
            times = min(int(part * share + 1e-6), int((rest[held] // pattern[held]).min()))
            if times:
                taken.append((pattern, times))
                rest = rest - pattern * times
        taken += best_fit(rest)
        if best is None or sum(n for _, n in taken) < sum(n for _, n in best):
            best = taken
    return made + best, bound + float(demand[capacity])


def _placement(made: list[tuple[np.ndarray, int]]) -> dict[str, np.ndarray]:
    """For each length and pattern that holds it: from which rank on, in which sequence first, how often, and where."""
    rows, base, ranks = [], 0, {}
    for pattern, times in made:
        offset = 0
        for length in np.flatnonzero(pattern)[::-1].tolist():
            count = int(pattern[length])
            rows.append((length, ranks.get(length, 0), base, count, offset))
            ranks[length] = ranks.get(length, 0) + count * times
            offset += count * length
        base += times
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "count", "offset"), columns))


PIECES = "piece int, start long, length long, ids_crc32 long, _block long, _local long"


def tokenize_pieces(
    documents: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each piece of each document; only documents of more than ``capacity`` ids have several.

    All pieces are full but the first. ``_local`` ranks the pieces of a length within one task (``_block``).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, block, seen = byte_bpe(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in small_batches(batches):
            rows: list[tuple] = []
            for i, ids in enumerate(model.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids = np.append(ids, np.array([end_id], dtype="<i4"))
                data, n, start, piece = ids.astype("<u4").tobytes(), len(ids), 0, 0
                while start < n:
                    length = (n - start) % capacity or capacity
                    rows.append((i, piece, start, length, unsigned_crc(data[4 * start : 4 * (start + length)]), seen[length]))
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            if not rows:
                continue
            at, *columns, local = map(list, zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0], pa.int32()),
                    *[pa.array(c, pa.int64()) for c in columns[1:]], pa.array([block] * len(rows), pa.int64()),
                    pa.array(local, pa.int64()),
                ],
                names=[id_col, "piece", "start", "length", "ids_crc32", "_block", "_local"],
            )

    id_type = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(cut, f"`{id_col}` {id_type}, {PIECES}")


def pack(
    documents: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Null and empty texts are one piece that holds the end id alone. Rows are packed one by one, so repeated rows and
    ids are packed as often as they stand, and other columns do not matter. An empty table gives no rows. The driver
    sees one number for each length (at most ``capacity``) and sends back a plan whose size does not depend on the
    data's. The narrow table of pieces is written to the staging folder once, so that ranks and places agree when a
    task runs again; no length is gathered in one task.
    """
    pieces = stage(tokenize_pieces(documents, path, capacity, end_id, id_col, text_col), "pieces")
    demand = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in pieces.groupBy("length").count().collect():
        demand[length] = count
    where = _placement(plan(demand, capacity)[0])
    scale = int(demand.max()) + 1
    keys = where["length"] * scale + where["rank"]
    ranked = class_ranks(pieces, "length", "_block", "_local", "_rank").drop("_block", "_local")
    names = ranked.columns

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(keys, length * scale + rank, side="right") - 1
            past = rank - where["rank"][at]
            sequence = where["sequence"][at] + past // where["count"][at]
            offset = where["offset"][at] + past % where["count"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*names[:-1], "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
    return ranked.mapInArrow(placed, f"{fields}, sequence_id long, offset long")
