"""Live heads of a store as a data source: ``spark.read.format("object_heads")``.

Options: ``root`` (the store), ``prefix`` (only keys that begin with it), ``from`` and ``to`` (only
keys between them, both included), ``bucket`` (what to call it),
``etags`` (``store``: as the store gives them, which plain file systems do not; ``md5``: digests of the
bodies, which are read for it), ``tasks`` (how many pieces of work to cut at least).

Planning lists folders, level by level, only until there are enough of them, and of a folder no more than
``PLANNED_NAMES`` names; whatever lies below a folder is listed by the task that gets it, row by row.
A folder with more names is dealt to several tasks, each of which takes the names that fall to it by
a hash, so that the dear part, a request or a digest per object, is spread. Folders that cannot hold a
key of the asked range are not entered. Filters of the frame are not pushed into the listing: in this
version of Spark all frames made from one share what was pushed by any of them (seen in a trial: after
``heads.filter(...)`` was counted, ``heads`` itself had lost the other rows).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..constants import DEFAULT_STORAGE_CLASS
from ..schemas import HEAD
from .store import ObjectRoot
from .tasks import overlapped

FORMAT_NAME = "object_heads"
PLANNED_NAMES = 10_000
TASKS = 32
_BATCH = 1000
_PIECE = 8 * 1024 * 1024
_HEAD_ARROW = pa.schema([
    ("bucket", pa.string()), ("key", pa.string()), ("content_length", pa.int64()),
    ("content_type", pa.string()), ("content_md5", pa.string()),
    ("last_modified", pa.timestamp("us")), ("etag", pa.string()), ("storage_class", pa.string()),
    ("metadata", pa.map_(pa.string(), pa.string())), ("version_id", pa.string()),
    ("cache_control", pa.string()), ("expires", pa.string()),
])
_USER = "x-amz-meta-"


@dataclass(frozen=True)
class KeyRange:
    """Keys that begin with ``prefix``, and are from ``low`` on and up to ``high`` (None: all)."""

    prefix: str = ""
    low: str = ""
    high: str | None = None

    def holds(self, key: str) -> bool:
        return key.startswith(self.prefix) and key >= self.low and (
            self.high is None or key <= self.high)

    def meets(self, folder: str) -> bool:
        """Whether a key below ``folder`` (with its slash) can be inside."""
        if not (folder.startswith(self.prefix) or self.prefix.startswith(folder)):
            return False
        if self.high is not None and folder > self.high:
            return False
        return folder >= self.low or self.low.startswith(folder)


@dataclass(frozen=True)
class Share(InputPartition):
    """A folder: with all below it, or its own objects only, of which ``of`` tasks take a share each."""

    folder: str
    below: bool = True
    index: int = 0
    of: int = 1


def _path(folder: str, name: str) -> str:
    return f"{folder}/{name}" if folder else name


def _children(root: ObjectRoot, folder: str, keys: KeyRange) -> tuple[list[str], int | None]:
    """Folders below ``folder`` that can hold a match, and the number of its own objects; None for the
    number where there are too many names to look at them all."""
    folders, own = [], 0
    for count, (name, is_folder, _, _) in enumerate(root.scan(folder), 1):
        if count > PLANNED_NAMES:
            return [], None
        if is_folder:
            if keys.meets(_path(folder, name) + "/"):
                folders.append(_path(folder, name))
        else:
            own += 1
    return folders, own


def shares(root: ObjectRoot, keys: KeyRange, tasks: int) -> list[Share]:
    """Pieces of work: at least ``tasks`` of them where the store has as many folders."""
    waiting, done = [""], []
    while waiting and len(waiting) + len(done) < tasks:
        level, waiting = waiting, []
        for folder in level:
            folders, own = _children(root, folder, keys)
            if own is None:
                # Its folders are entered by the task with the first share.
                done += [Share(folder, True, k, tasks) for k in range(tasks)]
            elif own:
                done.append(Share(folder, False))
            waiting += folders
    return done + [Share(folder) for folder in waiting]


def objects_of(root: ObjectRoot, share: Share, keys: KeyRange) -> Iterator[dict]:
    """``key, size, mtime_us`` of a piece of work, as the listing gives them."""
    folders = [share.folder]
    while folders:
        folder = folders.pop()
        dealt = share.of > 1 and folder == share.folder

        def own(name: str) -> bool:
            return zlib.crc32(name.encode("utf-8", "surrogatepass")) % share.of == share.index

        # The first share sees all names, for the folders among them.
        seen = root.scan(folder, own) if dealt and share.index else root.scan(folder)
        for name, is_folder, size, mtime_us in seen:
            key = _path(folder, name)
            if is_folder:
                if share.below and keys.meets(key + "/") and (not dealt or share.index == 0):
                    folders.append(key)
            elif keys.holds(key) and (not dealt or own(name)):
                yield {"key": key, "size": size, "mtime_us": mtime_us}


def _headers(root: ObjectRoot, key: str) -> dict[str, str]:
    """What the store knows about an object besides its size and time, names in lower case."""
    with root.files.open_input_stream(root.path(key)) as stream:
        found = stream.metadata() or {}
    return {k.decode().lower(): v.decode() for k, v in found.items()}


def _head(root: ObjectRoot, row: dict, bucket: str | None, etags: str) -> dict | None:
    """The head of one object; None if it went away meanwhile."""
    try:
        known = {} if root.files.type_name == "local" else _headers(root, row["key"])
        etag = known.get("etag", "").strip('"')
        if etags == "md5" and not etag:
            md5 = hashlib.md5(usedforsecurity=False)
            for piece in root.chunks(row["key"], _PIECE):
                md5.update(piece)
            etag = md5.hexdigest()
    except FileNotFoundError:
        return None
    return {
        "bucket": bucket, "key": row["key"], "content_length": row["size"],
        "content_type": known.get("content-type"), "content_md5": known.get("content-md5"),
        "last_modified": datetime.fromtimestamp(row["mtime_us"] / 1e6, timezone.utc).replace(tzinfo=None),
        "etag": etag, "storage_class": known.get("storage-class") or DEFAULT_STORAGE_CLASS,
        "metadata": [(k.removeprefix(_USER), v) for k, v in known.items() if k.startswith(_USER)],
        "version_id": known.get("versionid") or known.get("x-amz-version-id"),
        "cache_control": known.get("cache-control"), "expires": known.get("expires"),
    }


class HeadsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["root"]
        self.bucket = options.get("bucket")
        self.etags = options.get("etags", "store")
        self.tasks = int(options.get("tasks", TASKS))
        self.keys = KeyRange(options.get("prefix", ""), options.get("from", ""), options.get("to"))

    def partitions(self) -> list[Share]:
        return shares(ObjectRoot(self.root), self.keys, self.tasks) or [Share("", False)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        root = ObjectRoot(self.root)
        heads = overlapped(
            lambda row: _head(root, row, self.bucket, self.etags),
            objects_of(root, partition, self.keys))
        while rows := list(islice(heads, _BATCH)):
            yield pa.RecordBatch.from_pylist(rows, _HEAD_ARROW)


class ObjectHeads(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT_NAME

    def schema(self) -> StructType:
        return HEAD

    def reader(self, schema: StructType) -> HeadsReader:
        if "root" not in self.options:
            raise ValueError('option "root" is missing')
        return HeadsReader(dict(self.options))


def live_heads(
    spark: SparkSession, root: str, prefix: str = "", bucket: str | None = None,
    etags: str = "store", tasks: int = TASKS, first: str = "", last: str | None = None,
) -> DataFrame:
    """Heads of all objects of a store whose keys begin with ``prefix`` and lie from ``first`` up to
    ``last``, read when the frame is computed."""
    spark.dataSource.register(ObjectHeads)
    options = {"root": root, "prefix": prefix, "from": first, "etags": etags, "tasks": tasks}
    options |= {k: v for k, v in (("bucket", bucket), ("to", last)) if v is not None}
    return spark.read.format(FORMAT_NAME).options(**options).load()


def inventory_of(heads: DataFrame) -> DataFrame:
    """The listing that heads imply."""
    return heads.select(
        "bucket", "key", "last_modified", F.col("content_length").alias("size"), "storage_class",
        "etag", "version_id")
