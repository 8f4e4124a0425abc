"""A data source over a tree of files, each file paired with its side file in the task that lists its folder.

A file and its side file (`<stem>-lastmod.txt`) lie in one folder, so the task that lists the folder pairs
them: no list of files is gathered anywhere, and nothing is joined or shuffled. Planning looks at folders of
the upper `levels` only. Every folder is read by `shares` tasks, each taking the stems that hash to it, so a
folder with most of the files is read by several.

As a stream the source's offsets are points in time. A batch has the pairs that changed after one point and
until the next: a file rewritten in place counts as changed, and so does one whose side file comes late. A
pair that changes again comes again in a later batch, so a keyed upsert of all batches ends with the newest.

Options: `names` (patterns separated by `|`), `levels`, `shares`, and for streams `settle` (seconds by which a
batch ends before now, for stores whose clocks differ). Stores other than the local one are read through
pyarrow and have modification times only; on a local one the time of the last change of the entry counts too,
as copying may keep modification times.
"""

from __future__ import annotations

import fnmatch
import os
import posixpath
import sys
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lawloom.constants import LASTMOD_SUFFIX

# Tasks and planning workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIDE_SUFFIX = LASTMOD_SUFFIX
FORMAT = "lawloom_tree"
SCHEMA = "path string, body string, stamp_text string, changed timestamp"
ARROW = pa.schema(
    [("path", pa.string()), ("body", pa.string()), ("stamp_text", pa.string()), ("changed", pa.timestamp("us", "UTC"))]
)
LEVELS, SHARES = 3, 4
#: Rows and bytes of one batch of files given to the engine.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def opened(root: str) -> tuple[fs.FileSystem, str, str]:
    """File system of a root, its path there, and what stands before paths in their full names."""
    if "://" not in root:
        plain = root.removeprefix("file:")
        return fs.LocalFileSystem(), os.path.abspath(plain), "file://"
    store, path = fs.FileSystem.from_uri(root)
    scheme = root.split("://", 1)[0]
    if isinstance(store, fs.LocalFileSystem):
        return store, path, "file://"
    host = root.split("://", 1)[1].split("/", 1)[0]
    return store, path, f"{scheme}://" if path.startswith(host) else f"{scheme}://{host}"


def listed(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    return store.get_file_info(fs.FileSelector(folder, recursive=False, allow_not_found=True))


def changed_at(store: fs.FileSystem, info: fs.FileInfo) -> int:
    """Nanoseconds of a file's last change; 0 if it has gone meanwhile."""
    if isinstance(store, fs.LocalFileSystem):
        try:
            stat = os.stat(info.path)
        except FileNotFoundError:
            return 0
        return max(stat.st_mtime_ns, stat.st_ctime_ns)
    return info.mtime_ns or 0


@dataclass
class Share(InputPartition):
    """Part of a folder: the stems that hash to `share`, with all folders below if it is `whole`."""

    root: str
    folder: str
    whole: bool
    share: int
    shares: int
    names: tuple[str, ...]
    after: int | None = None
    until: int | None = None


def planned(options: dict) -> list[Share]:
    root, names = options["path"], tuple(options.get("names", "*").split("|"))
    levels, shares = int(options.get("levels", LEVELS)), int(options.get("shares", SHARES))
    store, top, _ = opened(root)
    if store.get_file_info(top).type != fs.FileType.Directory:
        raise FileNotFoundError(f"no folder {root}")
    out, now = [], [top]
    for level in range(levels + 1):
        out += [Share(root, f, level == levels, k, shares, names) for f in now for k in range(shares)]
        if level < levels:
            now = [x.path for f in now for x in listed(store, f) if x.type == fs.FileType.Directory]
    return out


def stem_of(name: str) -> str:
    """What a file and its side file have in common: the name up to its first dot."""
    return name.split(".", 1)[0]


def pairs_of(store: fs.FileSystem, part: Share) -> Iterator[tuple[str, str | None, int]]:
    """(path, path of the side file or None, changed) of the files of a share."""
    folders = [part.folder]
    while folders:
        entries = {}
        for x in listed(store, folders.pop()):
            if x.type == fs.FileType.Directory:
                if part.whole:
                    folders.append(x.path)
            else:
                entries[posixpath.basename(x.path)] = x
        for name, info in entries.items():
            stem = stem_of(name)
            if name.endswith(SIDE_SUFFIX) or not any(fnmatch.fnmatchcase(name, p) for p in part.names):
                continue
            if zlib.crc32(f"{posixpath.dirname(info.path)}/{stem}".encode()) % part.shares != part.share:
                continue
            side = entries.get(stem + SIDE_SUFFIX)
            changed = max(changed_at(store, info), changed_at(store, side) if side else 0)
            if part.after is None or part.after < changed <= part.until:
                yield info.path, side and side.path, changed


def content(store: fs.FileSystem, path: str | None) -> str | None:
    """A file's text; None if there is no such file (any more)."""
    if path is None:
        return None
    try:
        with store.open_input_stream(path) as file:
            return file.read().decode("utf-8", errors="replace")
    except FileNotFoundError:
        return None


def read_share(part: Share) -> Iterator[pa.RecordBatch]:
    store, _, before = opened(part.root)
    rows, size = [], 0
    for path, side, changed in pairs_of(store, part):
        body = content(store, path)
        if body is None:
            continue
        rows.append((before + path, body, content(store, side), changed // 1000))
        size += len(body)
        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


class TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Share]:
        return planned(self.options)

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return read_share(partition)


class TreeStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        return {"until": time.time_ns() - int(float(self.options.get("settle", 0)) * 1e9)}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        out = planned(self.options)
        for part in out:
            part.after, part.until = start["until"], end["until"]
        return out

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return read_share(partition)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class XmlTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TreeReader:
        return TreeReader(dict(self.options))

    def streamReader(self, schema) -> TreeStream:
        return TreeStream(dict(self.options))


def read_tree(spark: SparkSession, root: str, names: str = "*", **options: object) -> DataFrame:
    """One row per file below `root` whose name fits: path, body, stamp_text (side file's text or null), changed."""
    spark.dataSource.register(XmlTree)
    return spark.read.format(FORMAT).options(names=names, **options).load(root)


def stream_tree(spark: SparkSession, root: str, names: str = "*", **options: object) -> DataFrame:
    """The same as a stream of the pairs that are new or changed."""
    spark.dataSource.register(XmlTree)
    return spark.readStream.format(FORMAT).options(names=names, **options).load(root)
