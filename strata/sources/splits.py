"""CSV files of any size dealt to many tasks, quoted line breaks included.

A line break inside a quoted field ends no record, so a byte range of a file
can't be cut into records without what comes before it. The fingerprint pass
reads every byte of a file anyway: ``BorderScan`` follows the quotes through
its chunks and notes, about every ``SPLIT_BYTES``, where a record starts and
how many records lie before it. Reading a file is then a matter of its splits:
each is a byte range of whole records with its first record's number, and the
tasks that read them need nothing from each other.

In a chunk the state before a byte is the parity of the quotes before it, one
prefix sum. That holds where each opening quote starts a field and each closing
one ends it (or is doubled); chunks with other quotes (a stray quote in an
unquoted field is an ordinary character) are followed quote by quote.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a split, about (a record is never cut).
SPLIT_BYTES = 16 << 20
SPLITS_DDL = "array<struct<start:bigint,end:bigint,first_record:bigint>>"

_QUOTE, _BREAK, _RETURN = 0x22, 0x0A, 0x0D


class BorderScan:
    """Where the records of a file end, from its chunks in order."""

    def __init__(self, delimiter: str = ",", start_of_record: int = _BREAK):
        self._before = start_of_record  # the byte before what is not yet followed
        self._delimiter = delimiter.encode()[-1]
        self._inside = False
        self._held = b""
        self._at = 0  # file offset of the first byte of ``_held``

    def feed(self, chunk: bytes, last: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(offsets of the line breaks that end a record, the bytes before them), as far as they are known by now."""
        data = self._held + chunk
        # A quote is followed together with the byte after it.
        done = len(data) if last else len(data.rstrip(b'"'))
        if not last and done and data[done - 1] == _QUOTE:
            done = 0
        self._held, data = data[done:], data[:done]
        if not data:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        raw = np.frombuffer(data, dtype=np.uint8)
        toggles = self._toggles(raw)
        breaks = np.flatnonzero(raw == _BREAK)
        inside = (np.searchsorted(toggles, breaks) + self._inside) % 2 == 1
        breaks = breaks[~inside]
        before = np.where(breaks > 0, raw[breaks - 1], self._before)
        ends = breaks + self._at
        self._inside = bool((len(toggles) + self._inside) % 2)
        self._before, self._at = data[-1], self._at + len(data)
        return ends, before

    def _toggles(self, raw: np.ndarray) -> np.ndarray:
        """Positions of the quotes that open or close a field (doubled ones may count as closing and opening)."""
        quotes = np.flatnonzero(raw == _QUOTE)
        if not len(quotes):
            return quotes
        before = np.where(quotes > 0, raw[quotes - 1], self._before)
        # At the end of the file a closing quote needs nothing after it.
        after = np.where(quotes + 1 < len(raw), raw[np.minimum(quotes + 1, len(raw) - 1)], _BREAK)
        opening = (np.arange(len(quotes)) + self._inside) % 2 == 0
        starts = (before == self._delimiter) | (before == _BREAK) | (before == _QUOTE)
        ends = (after == self._delimiter) | (after == _BREAK) | (after == _RETURN) | (after == _QUOTE)
        if np.where(opening, starts, ends).all():
            return quotes
        out, inside, skip = [], self._inside, -1
        for q, b, a in zip(quotes.tolist(), before.tolist(), after.tolist()):
            if q == skip:
                continue
            if inside and a == _QUOTE and q + 1 < len(raw):
                skip = q + 1
            elif inside or b in (self._delimiter, _BREAK):
                out.append(q)
                inside = not inside
        return np.array(out, dtype=np.int64)


class SplitScan:
    """Splits of a file, from its chunks in order: (start, end, number of the first record from 0).

    The first record is the header; blank lines are no records.
    """

    def __init__(self, delimiter: str = ",", split_bytes: int = SPLIT_BYTES):
        self._borders, self._split = BorderScan(delimiter), split_bytes
        self._start = 0  # of the record that is not yet ended
        self._records = -1  # ended so far, without the header
        self._size, self._last = 0, b""
        self._starts: list[tuple[int, int]] = []

    def feed(self, chunk: bytes, last: bool = False) -> None:
        self._size += len(chunk)
        self._last = chunk[-1:] or self._last
        ends, before = self._borders.feed(chunk, last)
        if not len(ends):
            return
        width = ends - np.concatenate([[self._start], ends[:-1] + 1])
        counted = (width > 1) | (width == 1) & (before != _RETURN)
        if self._records < 0:
            counted[0] = True  # the header line, whatever it holds
        after = self._records + np.cumsum(counted)
        begin = ends + 1
        # The first record, and the first one in each further stretch of the file.
        stretch = begin // self._split
        known = self._starts[-1][0] // self._split if self._starts else -1
        self._starts += [(int(begin[i]), int(after[i])) for i in np.flatnonzero(np.diff(stretch, prepend=known) > 0)]
        self._records, self._start = int(after[-1]), int(begin[-1])

    def records(self) -> int:
        """Data records of the whole file; the last one needs no line break."""
        rest = self._size - self._start
        return max(0, self._records + (1 if rest > 1 or rest == 1 and self._last != b"\r" else 0))

    def splits(self) -> list[tuple[int, int, int]]:
        ends = [s for s, _ in self._starts[1:]] + [self._size]
        return [(s, e, n) for (s, n), e in zip(self._starts, ends) if s < e]


def record_texts(data: bytes, delimiter: str = ",") -> pa.Array:
    """The records of a byte range that starts with one, without their line breaks; blank lines are left out."""
    scan = BorderScan(delimiter)
    ends, _ = scan.feed(data, last=True)
    if not len(ends) or ends[-1] + 1 < len(data):
        ends = np.append(ends, len(data))
    starts = np.concatenate([[0], ends[:-1] + 1])
    raw = np.frombuffer(data, dtype=np.uint8)
    returned = (ends > starts) & (raw[np.maximum(ends - 1, 0)] == _RETURN)
    stops = ends - returned
    keep = stops > starts
    starts, stops = starts[keep], stops[keep]
    try:
        data.decode()
    except UnicodeDecodeError:
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), stops.tolist())], pa.string())
    # The kept bytes one after another are the array's buffer.
    depth = np.zeros(len(raw) + 1, dtype=np.int8)
    depth[starts] += 1
    np.subtract.at(depth, stops, 1)
    kept = raw[np.cumsum(depth[:-1], dtype=np.int8).astype(bool)] if len(starts) else raw[:0]
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(kept.tobytes()))


def file_records(chunks: Iterator[bytes], delimiter: str = ",") -> Iterator[pa.Array]:
    """The data records of a file (the first record is the header), from its chunks in order."""
    scan, held, at, header = BorderScan(delimiter), b"", 0, True  # ``at``: file offset of ``held``

    def cut(data: bytes) -> pa.Array:
        nonlocal header
        texts = record_texts(data, delimiter)
        if header and len(texts):
            texts, header = texts.slice(1), False
        return texts

    for chunk in chunks:
        held += chunk
        ends, _ = scan.feed(chunk)
        if len(ends):
            done = int(ends[-1]) + 1 - at
            yield cut(held[:done])
            held, at = held[done:], at + done
    if held:
        yield cut(held)


def _read_files(carried: list[str], delimiter: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from strata.sources.files import file_chunks

        for batch in batches:
            for k, path in enumerate(batch.column("path").to_pylist()):
                for texts in file_records(file_chunks(path), delimiter):
                    row = pa.array(np.full(len(texts), k, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([*[batch.column(c).take(row) for c in carried], texts], names=[*carried, "record"])

    return run


def whole_file_records(files: DataFrame, by: str, delimiter: str = ",", bytes_per_task: int = 4 * SPLIT_BYTES) -> DataFrame:
    """All columns of ``files`` (``path``, ``length``, others) but these two, and ``record``: one row for each data record.

    Files equal in ``by`` are read by one task, chunk by chunk, so their records
    lie together without a shuffle of them: only the paths are dealt.
    """
    from strata.session import ship_package

    spark = files.sparkSession
    ship_package(spark)
    carried = [c for c in files.columns if c not in ("path", "length")]
    size = files.agg(F.count_distinct(by).alias("n"), F.sum("length").alias("bytes")).first()
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(size["n"], max(slots, (size["bytes"] or 0) // bytes_per_task)))
    ddl = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in carried)
    return files.drop("length").repartition(tasks, by).mapInArrow(_read_files(carried, delimiter), f"{ddl}, record string")


def _read_splits(delimiter: str, rows: int = 65_536):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from strata.sources.files import read_range

        for batch in batches:
            for split in batch.to_pylist():
                texts = record_texts(read_range(split["source_uri"], split["start"], split["end"]), delimiter)
                for a in range(0, len(texts), rows):
                    part = texts.slice(a, rows)
                    numbers = np.arange(a, a + len(part)) + split["first_record"]
                    uri = pa.array([split["source_uri"]], pa.string()).take(pa.array(np.zeros(len(part), dtype=np.int32)))
                    yield pa.RecordBatch.from_arrays([uri, pa.array(numbers, pa.int64()), part], names=["source_uri", "record_index", "record"])

    return run


def split_records(files: DataFrame, delimiter: str = ",", tasks: int | None = None) -> DataFrame:
    """(source_uri, record_index from 0, record text) of all data records of files with their ``splits``.

    Splits of all files are dealt over the tasks by hash: a huge file is read by
    many of them, small files share one. Each byte is read once.
    """
    from strata.session import ship_package

    spark = files.sparkSession
    ship_package(spark)
    dealt = files.select("source_uri", F.inline("splits"))
    if tasks is None:
        size = dealt.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start")).alias("bytes")).first()
        slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Enough tasks for their bytes, never more than splits.
        tasks = max(1, min(size["n"], max(slots, (size["bytes"] or 0) // (4 * SPLIT_BYTES))))
    return dealt.repartition(tasks, "source_uri", "start").mapInArrow(
        _read_splits(delimiter), "source_uri string, record_index bigint, record string"
    )
