"""Exact deduplication through a cuckoo-filter index of live digests.

A text's digest is SHA-256 of its normalised UTF-8 bytes.  Every index task
keeps a cuckoo filter of the digests that are live in its bucket, the only way
to its entries: a miss is a new digest and is inserted; a hit's slot leads to
the stored digest that verifies it, and is merged.  Deletions take a digest out
of store and filter once its last row is gone.  A full filter is resized from
the stored keys.

The index runs twice: before the shuffle on each input partition (a digest
that a third of all rows share leaves one row per partition), and after it on
each bucket of digests.  Only digests and ids are shuffled, never texts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage

#: Live digests that a task before the shuffle holds before it passes them on.
FLUSH = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class CuckooFilter:
    """Places for 64-bit keys: a 16-bit mark and the number of a stored entry per slot.

    Four slots a bucket and two buckets a key, the second from the first and
    the mark alone.  ``find`` gives the entries that a key may be; ``insert``
    is False when the filter is full, and the caller then builds a larger one
    from its keys.
    """

    SLOTS, KICKS = 4, 200

    def __init__(self, capacity: int):
        buckets = 1
        while buckets * self.SLOTS * 0.9 < capacity:
            buckets *= 2
        self._mask = buckets - 1
        self._slots = array("H", bytes(2 * buckets * self.SLOTS))
        self._entries = array("I", bytes(4 * buckets * self.SLOTS))
        self._turn = 0

    def _places(self, key: int) -> tuple[int, int, int]:
        mark = (key >> 48) or 1
        first = key & self._mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self._mask

    def find(self, key: int) -> list[int]:
        """Entries whose slots carry the key's mark in one of its buckets."""
        mark, a, b = self._places(key)
        found = []
        for bucket in (a, b) if a != b else (a,):
            low = bucket * self.SLOTS
            if mark in self._slots[low : low + self.SLOTS]:
                found += [self._entries[i] for i in range(low, low + self.SLOTS) if self._slots[i] == mark]
        return found

    def __contains__(self, key: int) -> bool:
        return bool(self.find(key))

    def _put(self, bucket: int, mark: int, entry: int) -> bool:
        for i in range(bucket * self.SLOTS, (bucket + 1) * self.SLOTS):
            if not self._slots[i]:
                self._slots[i], self._entries[i] = mark, entry
                return True
        return False

    def insert(self, key: int, entry: int = 0) -> bool:
        mark, a, b = self._places(key)
        if self._put(a, mark, entry) or self._put(b, mark, entry):
            return True
        for _ in range(self.KICKS):
            self._turn += 1
            i = b * self.SLOTS + self._turn % self.SLOTS
            mark, self._slots[i] = self._slots[i], mark
            entry, self._entries[i] = self._entries[i], entry
            b = self._other(b, mark)
            if self._put(b, mark, entry):
                return True
        return False

    def delete(self, key: int, entry: int = 0) -> bool:
        mark, a, b = self._places(key)
        for bucket in (a, b):
            for i in range(bucket * self.SLOTS, (bucket + 1) * self.SLOTS):
                if self._slots[i] == mark and self._entries[i] == entry:
                    self._slots[i] = 0
                    return True
        return False


class LiveIndex:
    """Live digests of one bucket of digests, reached through the filter alone.

    An entry is a digest with its group's columns: the largest id, the first
    row and the number of rows that have it, and the number of all rows.
    Nothing else leads to an entry: a slot's hit is verified against the digest
    that its entry stores, a key without a verified hit is new.
    """

    def __init__(self, capacity: int = 1024):
        self._capacity = capacity
        self._filter = CuckooFilter(capacity)
        self._digests: list[bytes | None] = []
        self._groups: list[list | None] = []
        self._free: list[int] = []
        self.resized = 0

    def __len__(self) -> int:
        return len(self._digests) - len(self._free)

    @staticmethod
    def _key(digest: bytes) -> int:
        return int.from_bytes(digest[:8].ljust(8, b"\0"), "big")

    def _find(self, digest: bytes, key: int) -> int | None:
        for entry in self._filter.find(key):
            if self._digests[entry] == digest:
                return entry
        return None

    def _grow(self) -> None:
        full = False
        while not full:
            self._capacity *= 2
            self.resized += 1
            self._filter = CuckooFilter(self._capacity)
            full = all(self._filter.insert(self._key(d), i) for i, d in enumerate(self._digests) if d is not None)

    @property
    def rows(self) -> dict[bytes, tuple]:
        """(largest id, all rows) by live digest."""
        return {d: (g[0], g[3]) for d, g in zip(self._digests, self._groups) if d is not None}

    def add(self, digest: bytes, doc_id: int | None, n: int = 1, row: int = 0, same: int = 1) -> None:
        """``n`` rows with this digest, ``same`` of them with ``doc_id``, from ``row`` on; the largest id stays (null is below every id)."""
        key = self._key(digest)
        entry = self._find(digest, key)
        if entry is None:
            if self._free:
                entry = self._free.pop()
            else:
                entry = len(self._digests)
                self._digests.append(None)
                self._groups.append(None)
            self._digests[entry], self._groups[entry] = digest, [doc_id, row, same, n]
            if not self._filter.insert(key, entry):
                self._grow()
            return
        group = self._groups[entry]
        group[3] += n
        if doc_id == group[0]:
            group[1] = min(group[1], row)
            group[2] += same
        elif group[0] is None or (doc_id is not None and doc_id > group[0]):
            group[:3] = doc_id, row, same

    def remove(self, digest: bytes, n: int = 1) -> bool:
        """Takes ``n`` rows away; the digest dies with its last row.  False if it isn't live."""
        key = self._key(digest)
        entry = self._find(digest, key)
        if entry is None:
            return False
        self._groups[entry][3] -= n
        if self._groups[entry][3] <= 0:
            self._filter.delete(key, entry)
            self._digests[entry] = self._groups[entry] = None
            self._free.append(entry)
        return True

    def take(self) -> tuple[list, list]:
        """All live digests and their groups; the index is empty afterwards."""
        live = [(d, g) for d, g in zip(self._digests, self._groups) if d is not None]
        self.__init__(self._capacity)
        return [d for d, _ in live], [g for _, g in live]


_INDEX_SCHEMA = "digest binary, keep_id bigint, keep_row bigint, keep_rows bigint, group_size bigint"
_INDEX_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def _fold(limit: int | None):
    """Arrow task that runs (digest, id, row, rows with the id, n) through a live index; n < 0 deletes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LiveIndex()

        def out():
            digests, groups = index.take()
            for a in range(0, len(digests), 50_000):
                columns = [digests[a : a + 50_000], *zip(*groups[a : a + 50_000])]
                arrays = [pa.array(c, t) for c, t in zip(columns, _INDEX_TYPES)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _INDEX_SCHEMA.split(", ")])

        for batch in batches:
            for digest, doc_id, row, same, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if n > 0:
                    index.add(digest, doc_id, n, row, same)
                else:
                    index.remove(digest, -n)
            if limit and len(index) >= limit:
                yield from out()
        yield from out()

    return run


def digests(docs: DataFrame, text: str = "text") -> "F.Column":
    """SHA-256 of the text in UTF-8 with A-Z lower-cased; null counts as empty."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.unhex(F.sha2(F.encode(plain, "UTF-8"), 256))


def live_index(rows: DataFrame) -> DataFrame:
    """(digest, doc_id) with row and n, if any -> one row per digest: digest, keep_id, keep_row, keep_rows, group_size.

    ``keep_id`` is the largest id (null is below every id), ``keep_rows`` the
    number of rows that have it and ``keep_row`` the smallest ``row`` of them
    (0 without the column); a row counts ``n`` times (once without the column).
    """
    row = F.col("row") if "row" in rows.columns else F.lit(0)
    n = (F.col("n") if "n" in rows.columns else F.lit(1)).cast("bigint")
    counted = rows.select("digest", "doc_id", row.cast("bigint").alias("row"), n.alias("same"), n.alias("n"))
    partial = counted.mapInArrow(_fold(FLUSH), _INDEX_SCHEMA)
    return partial.repartition("digest").mapInArrow(_fold(None), _INDEX_SCHEMA)


def maintain(live: DataFrame, inserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """Next version of an index: ``live`` (as of ``live_index``), then insertions, then deletions.

    ``inserts`` and ``deletes`` have (digest, doc_id).  Returns the columns of
    ``live`` for the digests that are still live; deleting the row that
    stays leaves ``keep_id`` as it is until the group is empty.
    """
    zero = F.lit(0).cast("bigint")
    new = live_index(inserts.select("digest", "doc_id"))
    gone = deletes.groupBy("digest").agg((-F.count("*")).alias("group_size"))
    gone = gone.select("digest", F.lit(None).cast("bigint").alias("keep_id"), zero.alias("keep_row"), zero.alias("keep_rows"), "group_size")
    events = live.withColumn("step", F.lit(0)).unionByName(new.withColumn("step", F.lit(1))).unionByName(gone.withColumn("step", F.lit(2)))
    ordered = events.repartition("digest").sortWithinPartitions("step").drop("step")
    return ordered.mapInArrow(_fold(None), _INDEX_SCHEMA)


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; null is the
    empty text.  Of equal texts the row with the largest id stays (null is
    below every id; of rows with the same text and id, exactly one stays).
    Texts of any length are read whole, once: digests, ids and row numbers are
    staged.  An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), digests(docs, text).alias("digest"))
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    live = live_index(rows).withColumnRenamed("digest", "_digest")
    return rows.join(live, F.col("digest") == F.col("_digest")).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns whatever their names (see ``exact_duplicates``).

    The rows are joined to the groups of two or more.  Of rows that repeat the
    surviving text and id, the first in the order of the row's JSON text stays,
    whatever the order of the input; null and empty texts are one group; an
    empty table gives no rows.
    """
    keys = docs.select(digests(docs, text).alias("digest"), F.col(id).cast("bigint").alias("doc_id"))
    groups = cut_lineage(live_index(keys).where("group_size > 1"), "equal-texts")
    packed = docs.select(F.struct("*").alias("row"), F.col(id).cast("bigint").alias("id"), digests(docs, text).alias("digest"))
    # One way at every size: the groups grow with the rows, so they aren't sent whole while they are few.
    repeated = groups.select(F.col("digest").alias("group"), "keep_id", "keep_rows").hint("merge")
    found = packed.join(repeated, F.col("digest") == F.col("group"), "left")
    found = found.where(F.col("group").isNull() | F.col("id").eqNullSafe(F.col("keep_id")))
    if groups.where("keep_rows > 1").isEmpty():
        return found.select("row.*")
    several = F.coalesce(F.col("keep_rows") > 1, F.lit(False))
    first = found.where(several).groupBy("group").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return found.where(~several).select("row").unionByName(first.select("row")).select("row.*")


def brute_force(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """The contract of ``exact_duplicates`` on a list of (doc_id, text), for tests."""
    plain = [hashlib.sha256((t or "").translate(str.maketrans(_UPPER, _LOWER)).encode()).hexdigest() for _, t in rows]
    out, seen = [], set()
    for (i, _), h in zip(rows, plain):
        ids = [j for (j, _), g in zip(rows, plain) if g == h]
        keep = max((j for j in ids if j is not None), default=None)
        first = i == keep and (h, i) not in seen
        seen.add((h, i))
        out.append((i, keep, len(ids), first, h))
    return out
