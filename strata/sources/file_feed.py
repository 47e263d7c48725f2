"""Raw files as a stream that knows re-deliveries.

Spark's file stream remembers paths: a file that is delivered again under its
name is not seen. This source compares (uri, length, modification time), as the
batch job does. An offset is the number of a version; a version is a file of a
log beside the checkpoint that lists the files that are new or changed since
the version before it. A version is written before the offset that names it is
handed out, and is never changed, so a batch that runs again gets the same files. Every tenth version
carries the whole listing, from which a restart goes on.

Only paths, sizes and times are streamed. Listing and log go through pyarrow's
file systems (local, hdfs, s3, gs) in the query's driver process, as Spark's own file stream
lists on the driver.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Every so many versions the log holds the whole listing.
SNAPSHOT_EVERY = 10
FORMAT = "strata_file_feed"


def _place(path: str):
    """(file system, path in it, what a path of that file system lacks to be the URI that Spark gives it)."""
    from strata.sources.files import file_system

    store, inner = file_system(path)
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return store, inner.rstrip("/"), "file:"
    authority = rest.removeprefix("//").partition("/")[0]
    # Object stores count the bucket to the path.
    return store, inner.rstrip("/"), f"{scheme}://" if scheme != "hdfs" else f"hdfs://{authority}"


def list_folder(path: str) -> dict[str, tuple[int, int]]:
    """uri -> (length, modification time in ms) of the csv files below a folder; names that begin with ``_`` or ``.`` are no data."""
    from pyarrow import fs

    store, root, lead = _place(path)
    out = {}
    for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        inside = info.path[len(root) :].strip("/").split("/")
        if info.type == fs.FileType.File and info.path.lower().endswith(".csv") and not any(p[:1] in "_." for p in inside):
            out[lead + info.path] = (info.size, info.mtime_ns // 1_000_000)
    return out


class VersionLog:
    """Versions of a listing: each a JSON file of its new or changed files."""

    def __init__(self, path: str):
        self._path = path.rstrip("/")

    def _name(self, version: int) -> str:
        return f"{self._path}/{version:012d}.json"

    def newest(self) -> int:
        from pyarrow import fs

        store, root, _ = _place(self._path)
        names = [i.base_name for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.base_name.endswith(".json")]
        return max((int(n[:12]) for n in names if n[:12].isdigit()), default=0)

    def read(self, version: int) -> dict:
        store, inner, _ = _place(self._name(version))
        with store.open_input_stream(inner) as f:
            return json.loads(f.read())

    def write(self, version: int, content: dict) -> None:
        store, inner, _ = _place(self._name(version))
        store.create_dir(inner.rpartition("/")[0], recursive=True)
        with store.open_output_stream(inner + ".tmp") as f:
            f.write(json.dumps(content).encode())
        store.move(inner + ".tmp", inner)

    def state(self) -> tuple[int, dict[str, tuple[int, int]]]:
        """(newest version, the listing as of it), from the last snapshot on."""
        newest = self.newest()
        changes: list[dict] = []
        for v in range(newest, 0, -1):
            content = self.read(v)
            changes.append(content.get("all") or content["files"])
            if "all" in content:
                break
        known: dict[str, tuple[int, int]] = {}
        for c in reversed(changes):
            known |= {u: tuple(x) for u, x in c.items()}
        return newest, known


class Version(InputPartition):
    def __init__(self, version: int):
        self.version = version


class FileFeedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self._folder, self._limit = options["path"], int(options.get("maxfiles", 0))
        self._log_path = options["log"]
        self._newest: int | None = None
        self._known: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        log = VersionLog(self._log_path)
        if self._newest is None:
            self._newest, self._known = log.state()
        found = list_folder(self._folder)
        new = sorted(u for u, x in found.items() if self._known.get(u) != x)
        if self._limit:
            new = new[: self._limit]
        if new:
            files = {u: found[u] for u in new}
            known, version = self._known | files, self._newest + 1
            log.write(version, {"files": files} | ({"all": known} if version % SNAPSHOT_EVERY == 0 else {}))
            self._newest, self._known = version, known
        return {"version": self._newest}

    def partitions(self, start: dict, end: dict) -> list[Version]:
        return [Version(v) for v in range(start["version"] + 1, end["version"] + 1)]

    def read(self, partition: Version) -> Iterator[tuple]:
        for uri, (length, ms) in VersionLog(self._log_path).read(partition.version)["files"].items():
            yield uri, length, _dt.datetime.fromtimestamp(ms / 1000, _dt.timezone.utc)

    def commit(self, end: dict) -> None:
        """Versions stay: a restart without its checkpoint reads them from the first on."""


class FileFeed(DataSource):
    """``path``: the folder; ``log``: where the versions are kept; ``maxfiles``: files of a version at most (0: all)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, length bigint, modificationTime timestamp"

    def streamReader(self, schema) -> FileFeedReader:
        return FileFeedReader({k.lower(): v for k, v in self.options.items()})
