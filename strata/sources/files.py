"""Raw files: discovery, fingerprints, header lines and the CSV read (SURVEY §2.1
S1-S7, §2.2 F1-F2, §8.1-8.3, §8.13, §8.18, §8.19).

Fingerprints are taken on the executors: each file of the list is opened there
and read once, in chunks, for its hash, its record count and its header, so
no file is held whole and none is too large.
The CSV read groups files by their header line (few distinct headers) and
reads each group with its own all-string schema, because Spark maps a given
schema by position.
"""

from __future__ import annotations

import csv
import hashlib
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expr import PANDAS_NULL_TOKENS, file_name, null_tokens, source_date_from_name
from strata.plans.numbering import number_in_scan_order
from strata.schemas import RAW_COLUMNS
from strata.session import ship_package
from strata.sources.splits import SPLIT_BYTES, SPLITS_DDL, SplitScan, split_records

# ---- fixed values: file filters of discovery ----
CSV_GLOB = "*.[cC][sS][vV]"
TEST_FOLDER = "/test/"
# Bytes read at once.
CHUNK_BYTES = 1 << 20
CORRUPT_COL = "_corrupt_record"


LISTING = "path string, length bigint, modificationTime timestamp"
# Modification time of zero-byte files, whose fingerprint does not depend on it.
EMPTY_FILE_TIME = "1970-01-01 00:00:00+00:00"


def list_files(spark: SparkSession, raw_path: str) -> DataFrame:
    """Recursive listing (path, length, modificationTime) of csv files in any case.

    Spark's file index lists the folders (with executors, where there are many);
    sizes and times come from a scan that opens no file. Scans skip zero-byte
    files, so those are taken from the index, with a fixed time. Names and
    folders that begin with ``_`` or ``.`` are no data, as in every Spark read.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(raw_path)
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], LISTING)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", CSV_GLOB)
    found = reader.load(raw_path).select("path", "length", "modificationTime")
    # The index gives URIs; a scan's path has one slash where no host is named.
    indexed = [(re.sub(r"^([^:/]+):///", r"\1:/", unquote(p)),) for p in found.inputFiles()]
    sized = found.select("path")
    empty = (
        spark.createDataFrame(indexed, "path string")
        .join(sized, on="path", how="left_anti")
        .select("path", F.lit(0).cast("bigint").alias("length"), F.lit(EMPTY_FILE_TIME).cast("timestamp").alias("modificationTime"))
    )
    return found.unionByName(empty)


def discover(
    spark: SparkSession, raw_path: str, date_from: str = "name", exclude_test: bool = True, listing: DataFrame | None = None
) -> DataFrame:
    """Csv files (any case) below ``raw_path``, minus ``/test/`` folders and
    names without a real date, sorted by (date, name, uri).

    ``date_from="name"``: ``retail_sales_YYYYMMDD.csv`` (case-sensitive);
    ``"partition"``: a ``source_date=YYYY-MM-DD`` folder (part files written by Spark);
    ``"either"``: the name's date or else the folder's.
    File contents are not read (only path, length and modification time).
    ``listing`` (as of ``list_files``) saves listing the folder.
    """
    df = list_files(spark, raw_path) if listing is None else listing
    if exclude_test:
        df = df.filter(~F.col("path").contains(TEST_FOLDER))
    name = file_name(F.col("path"))
    folder = F.try_to_date(F.regexp_extract(F.col("path"), r"source_date=(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    dates = {"name": source_date_from_name(name), "partition": folder}
    dates["either"] = F.coalesce(dates["name"], folder)
    d = dates[date_from]
    out = df.select(
        F.col("path").alias("source_uri"),
        name.alias("source_file"),
        d.alias("source_date"),
        F.col("length"),
        F.col("modificationTime").alias("modification_time"),
    )
    return out.filter(F.col("source_date").isNotNull()).orderBy("source_date", "source_file", "source_uri")


FINGERPRINT_COLUMNS = ["source_uri", "length", "modification_time", "source_checksum", "physical_records", "header", "delimiter", "records", "splits"]


def file_system(path: str):
    """(file system, path in it) of a file that Spark listed, for opening it on an executor."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        local = rest if colon else path
        return fs.LocalFileSystem(), "/" + local.lstrip("/")
    authority, _, inner = rest.removeprefix("//").partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{authority}/")
    return store, f"{base.rstrip('/')}/{inner}"


def opens(path: str) -> bool:
    """Whether ``open_file`` knows the scheme of a file that Spark listed."""
    try:
        file_system(path)
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def open_file(path: str):
    """A readable byte stream of a file."""
    store, inner = file_system(path)
    return store.open_input_stream(inner)


def read_range(path: str, start: int, end: int) -> bytes:
    """The bytes [start, end) of a file."""
    store, inner = file_system(path)
    with store.open_input_file(inner) as f:
        f.seek(start)
        return f.read(end - start)


def file_chunks(path: str, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    with open_file(path) as stream:
        while chunk := stream.read(size):
            yield chunk


def scan_file(
    path: str, size: int = CHUNK_BYTES, delimiter: str = ",", split_bytes: int = SPLIT_BYTES
) -> tuple[str, int, list[str] | None, int, list[tuple[int, int, int]]]:
    """(sha256, physical records, header names, records, splits) of a file in one pass over its chunks."""
    digest, newlines, last, head, open_head = hashlib.sha256(), 0, b"", [], True
    scan = SplitScan(delimiter, split_bytes)
    for chunk in file_chunks(path, size):
        digest.update(chunk)
        scan.feed(chunk)
        newlines += chunk.count(b"\n")
        last = chunk[-1:]
        if open_head:
            line, end, _ = chunk.partition(b"\n")
            head.append(line)
            open_head = not end
    scan.feed(b"", last=True)
    lines = newlines + (1 if last and last != b"\n" else 0)
    text = b"".join(head).decode("utf-8", "replace").removeprefix("\ufeff").removesuffix("\r")
    names = [n.strip() for n in next(csv.reader([text], skipinitialspace=True, delimiter=delimiter), [])] if text else None
    return digest.hexdigest(), max(lines - 1, 0), names, scan.records(), scan.splits()


def describe_file(path: str, size: int = CHUNK_BYTES, delimiter: str = ",") -> tuple[str, int, list[str] | None]:
    """(sha256, physical records, header names) of a file in one pass over its chunks."""
    return scan_file(path, size, delimiter)[:3]


_DESCRIBED = f"source_uri string, source_checksum string, physical_records bigint, header array<string>, delimiter string, records bigint, splits {SPLITS_DDL}"


def _describe(delimiter: str, split_bytes: int):
    split_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_record", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("source_uri").to_pylist()
            found = [scan_file(p, delimiter=delimiter, split_bytes=split_bytes) for p in paths]
            splits = [[{"start": a, "end": b, "first_record": n} for a, b, n in f[4]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.string()),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.list_(pa.string())),
                    pa.array([delimiter] * len(paths), pa.string()),
                    pa.array([f[3] for f in found], pa.int64()),
                    pa.array(splits, split_type),
                ],
                names=["source_uri", "source_checksum", "physical_records", "header", "delimiter", "records", "splits"],
            )

    return run


def spread(files: DataFrame) -> DataFrame:
    """File rows dealt evenly over the session's shuffle partitions; a task opens few files."""
    ship_package(files.sparkSession)
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source_uri")


def fingerprint(
    spark: SparkSession,
    raw_path: str,
    files: DataFrame | None = None,
    cache: DataFrame | None = None,
    delimiter: str = ",",
    split_bytes: int | None = None,
) -> DataFrame:
    """F1/F2 + header line and splits per file.

    sha256 of the bytes (lower hex), byte length, physical record count (lines - 1,
    at least 0, as the reference counts), and the header as an array of names
    (byte-order mark and a trailing CR removed, surrounding quotes stripped).
    ``splits`` are byte ranges of whole records with their first record's number
    (``sources.splits``), found in the same pass, as are the ``records`` (quoted
    line breaks end none, blank lines are none).

    Only files that need it are read: ``files`` (as of ``discover``) restricts the set
    and saves listing the folder, and a
    ``cache`` of earlier fingerprints (same columns) is reused for files whose
    (uri, length, modification time) did not change, so a run over a growing
    archive hashes only new or rewritten files. A file of any size is read, in
    chunks; zero-byte files get the hash of nothing and no header.
    """
    if files is not None:
        listing = files.select("source_uri", "length", "modification_time")
    else:
        listing = list_files(spark, raw_path).select(
            F.col("path").alias("source_uri"), "length", F.col("modificationTime").alias("modification_time")
        )
    reused = None
    # A cache of an earlier layout has no splits; those files are read once more.
    if cache is not None and set(FINGERPRINT_COLUMNS) <= set(cache.columns):
        known = cache.select(*FINGERPRINT_COLUMNS).where(F.col("delimiter") == delimiter)
        reused = known.join(listing, on=["source_uri", "length", "modification_time"], how="left_semi")
        listing = listing.join(known, on=["source_uri", "length", "modification_time"], how="left_anti")
    described = spread(listing.select("source_uri")).mapInArrow(_describe(delimiter, split_bytes or SPLIT_BYTES), _DESCRIBED)
    fresh = listing.join(described, on="source_uri").select(*FINGERPRINT_COLUMNS)
    return fresh if reused is None else fresh.unionByName(reused)


def _string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names] + [T.StructField(CORRUPT_COL, T.StringType(), True)])


def read_group(
    spark: SparkSession,
    paths: Sequence[str],
    header: Sequence[str],
    contract: Sequence[str] = RAW_COLUMNS,
    multiline: bool = True,
    tokens: Sequence[str] | None = PANDAS_NULL_TOKENS,
) -> DataFrame:
    """S4-S6 for files sharing one header: all-string read in that header's order,
    doubled quotes decoded, quoted newlines kept (``multiline``), malformed rows
    kept with their raw text; then contract order, null tokens, record numbers
    (data-row index + 2 in physical order) and an ``extra_fields`` flag (a row
    with more fields than the header is a file error)."""
    reader = (
        spark.read.schema(_string_schema(header))
        .option("header", "true")
        .option("escape", '"')
        .option("multiLine", str(multiline).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .option("enforceSchema", "true")
    )
    df = reader.csv(list(paths)).select(
        "*",
        F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_block_start").alias("_block_start"),
    )
    df = number_in_scan_order(df, "_file_path", "_block_start", out="_row_index")
    wide = ", ".join(f"c{i} string" for i in range(len(header) + 1))
    extra = F.when(
        F.col(CORRUPT_COL).isNotNull(),
        F.from_csv(F.col(CORRUPT_COL), wide, {"escape": '"'}).getField(f"c{len(header)}").isNotNull(),
    ).otherwise(F.lit(False))
    cols = []
    for c in contract:
        v = F.col(c) if c in header else F.lit(None).cast("string")
        cols.append((null_tokens(v, tokens) if tokens else v).alias(c))
    return df.select(
        F.col("_file_path").alias("source_uri"),
        (F.col("_row_index") + 2).alias("record_number"),
        *cols,
        extra.alias("extra_fields"),
    )


def read_split_group(
    files: DataFrame,
    header: Sequence[str],
    contract: Sequence[str] = RAW_COLUMNS,
    tokens: Sequence[str] | None = PANDAS_NULL_TOKENS,
    delimiter: str = ",",
    tasks: int | None = None,
) -> DataFrame:
    """S4-S6 by splits, for files sharing one header (``source_uri``, ``splits``).

    The records are cut by their tasks and parsed by Spark's own CSV parser, one
    record at a time, so quoted line breaks and doubled quotes read as in a
    sequential read. Columns and flags are those of ``read_group``; record
    numbers come with the splits, without a second scan or a join.
    """
    records = split_records(files, delimiter, tasks)
    wide = ", ".join(f"c{i} string" for i in range(len(header) + 1))
    parsed = F.from_csv(F.col("record"), wide, {"escape": '"', "sep": delimiter})
    rows = records.select("source_uri", (F.col("record_index") + 2).alias("record_number"), F.inline(F.array(parsed)))
    cols = []
    for c in contract:
        v = F.col(f"c{list(header).index(c)}") if c in header else F.lit(None).cast("string")
        cols.append((null_tokens(v, tokens) if tokens else v).alias(c))
    return rows.select("source_uri", "record_number", *cols, F.col(f"c{len(header)}").isNotNull().alias("extra_fields"))


def read_lines(
    spark: SparkSession,
    files: DataFrame,
    contract: Sequence[str] = RAW_COLUMNS,
    multiline: bool = True,
    tokens: Sequence[str] | None = PANDAS_NULL_TOKENS,
    delimiter: str = ",",
) -> DataFrame:
    """Read many files with possibly different headers: one read per distinct header.

    ``files`` has ``source_uri``, ``header`` (array) and, as ``fingerprint`` gives
    them, ``splits``. Only the distinct headers reach the driver (metadata, not
    rows). Without splits whole files are scanned by Spark's CSV source, and
    their list reaches the driver too. The rows are unioned by name in contract order.
    """
    if "splits" in files.columns:
        headers = [tuple(r["header"]) for r in files.select("header").distinct().collect() if r["header"]]
        same = F.concat_ws("\x00", "header")
        frames = [read_split_group(files.where(same == "\x00".join(h)), h, contract, tokens, delimiter) for h in sorted(headers)]
    else:
        groups: dict[tuple, list[str]] = {}
        for row in files.select("source_uri", "header").collect():
            groups.setdefault(tuple(row["header"] or ()), []).append(row["source_uri"])
        frames = [read_group(spark, paths, list(header), contract, multiline, tokens) for header, paths in groups.items() if header]
    if not frames:
        schema = "source_uri string, record_number bigint, " + ", ".join(f"{c} string" for c in contract) + ", extra_fields boolean"
        return spark.createDataFrame([], schema)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


MANIFEST_DDL = "provider_id string, source_date string, file_name string, relative_path string, record_count bigint, sha256 string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest CSV with its declared schema."""
    return spark.read.schema(MANIFEST_DDL).option("header", "true").csv(path)
