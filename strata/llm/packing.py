"""Packing token sequences into windows by minimum bin slack.

Each input partition keeps a bounded pool of pieces.  A window starts with the
longest one; a subset-sum dynamic programme over a bitset (one Python integer,
bit n: a sum of n can be reached) picks from the multiset of remaining lengths
the one that comes closest to the capacity, and backtracking over the bitsets
counts how many pieces of each length it takes.  If the window is still short,
a remaining piece is cut to fill it.  Only the last window of a partition can
be short; it is cut into windows of powers of two, which need no padding.

There is no shuffle: every partition packs its own documents, and window
numbers carry the partition's number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_chunks
from strata.llm.tokens import encoder_of

#: Tokens of a window.
WINDOW = 2048
#: Pieces from which a window is chosen.
POOL = 192


def closest_subset(lengths: list[tuple[int, int]], capacity: int) -> dict[int, int]:
    """How many pieces of each length to take so that their sum is as close below ``capacity`` as can be.

    ``lengths``: (length, how many there are).
    """
    mask, full = (1 << (capacity + 1)) - 1, 1 << capacity
    reach, steps = 1, []
    for length, n in lengths:
        if length > capacity:
            continue
        before = reach
        for _ in range(min(n, capacity // length)):
            more = reach | (reach << length) & mask
            if more == reach:
                break
            reach = more
        steps.append((length, before))
        if reach & full:
            break
    left, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> left & 1:
            taken[length] = taken.get(length, 0) + 1
            left -= length
    return taken


class Packer:
    """Windows from a stream of documents' ids; ``emit`` gets (window, offset, piece) rows."""

    def __init__(self, window: int = WINDOW, pool: int = POOL, first: int = 0):
        self.window, self.pool = window, pool
        self._by_length: dict[int, list] = {}
        self._n, self._next = 0, first
        self.rows: list[tuple] = []

    def _put(self, piece: tuple) -> None:
        self._by_length.setdefault(len(piece[2]), []).append(piece)
        self._n += 1

    def _take(self, length: int) -> tuple:
        pieces = self._by_length[length]
        out = pieces.pop()
        if not pieces:
            del self._by_length[length]
        self._n -= 1
        return out

    def _write(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, ids, total, self._next, offset))
            offset += len(ids)
        self._next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        """A document's ids: whole windows at once, the rest into the pool."""
        total, whole = len(ids), len(ids) - len(ids) % self.window
        for a in range(0, whole, self.window):
            self._write([(doc, a, ids[a : a + self.window], total)])
        if whole < total:
            self._put((doc, whole, ids[whole:], total))
        while self._n > self.pool:
            self._window()

    def _window(self) -> None:
        lengths = sorted(self._by_length, reverse=True)
        pieces = [self._take(lengths[0])]
        room = self.window - len(pieces[0][2])
        if room:
            counts = [(n, len(self._by_length[n])) for n in sorted(self._by_length, reverse=True)]
            for length, n in closest_subset(counts, room).items():
                pieces += [self._take(length) for _ in range(n)]
                room -= length * n
        while room and self._n:  # what is left is longer than the room, or nothing
            doc, start, ids, total = self._take(max(self._by_length))
            pieces.append((doc, start, ids[:room], total))
            if len(ids) > room:
                self._put((doc, start + room, ids[room:], total))
            room -= min(room, len(ids))
        if room:
            self._powers(pieces)
        else:
            self._write(pieces)

    def _powers(self, pieces: list[tuple]) -> None:
        """A short window as windows of powers of two, largest first."""
        left = sum(len(p[2]) for p in pieces)
        while left:
            size = room = 1 << (left.bit_length() - 1)
            part = []
            while room:
                doc, start, ids, total = pieces.pop(0)
                part.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    pieces.insert(0, (doc, start + room, ids[room:], total))
                room -= min(room, len(ids))
            self._write(part)
            left -= size

    def finish(self) -> None:
        while self._n:
            self._window()


_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pack(path: str, end: int, window: int, pool: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_of(path, "dropped")
        packer = Packer(window, pool, TaskContext.get().partitionId() << 33)

        def out():
            rows, packer.rows = packer.rows, []
            if rows:
                doc, start, ids, total, sequence, offset = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc, pa.int64()),
                        pa.array(start, pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                        pa.array(total, pa.int64()),
                        pa.array(sequence, pa.int64()),
                        pa.array(offset, pa.int64()),
                    ],
                    names=[f.split()[0] for f in _SCHEMA.split(", ")],
                )

        for batch in text_chunks(batches, target=2_000_000):
            docs = batch.column("doc_id").to_pylist()
            ids, counts = encoder.encode([t or "" for t in batch.column("text").to_pylist()], end)
            for doc, part in zip(docs, np.split(ids, np.cumsum(counts)[:-1])):
                packer.add(doc, part)
            yield from out()
        packer.finish()
        yield from out()

    return run


def pack(docs: DataFrame, path: str, end: int = 1, id: str = "doc_id", text: str = "text", window: int = WINDOW, pool: int = POOL) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    A document is its text's ids and the id ``end``; null texts are empty and
    have that id only.  Every id lies in one piece; pieces of a sequence stand
    gapless from offset 0; sequences have ``window`` ids or a power of two.
    Repeated rows are packed each; an empty table gives no rows.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_pack(path, end, window, pool), _SCHEMA)
