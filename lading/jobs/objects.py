"""Jobs that move, remove and digest object bodies.

Each returns a lazy table of results whose computation has side effects. Write that table
once and count from what was written: every further action would do the work again. Repeats
through task retries are harmless, since copies replace whole objects and deletes of absent
objects succeed.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import DEFAULT_STORAGE_CLASS, PART_BYTES
from ..functions.keys import from_micros
from ..operators.running import byte_slices, running_totals
from ..schemas import RESULT
from ..session import new_run_dir, stored
from ..sources.bodies import content_digest
from .checkpoints import CheckpointLog
from .parts import copy_in_parts, headers_of
from .stopping import StopFlag
from .store import ObjectRoot
from .tasks import RESULT_ARROW, default_tasks, per_row, result_of

_CONTENT_ARROW = pa.schema([("key", pa.string()), ("content", pa.binary())])
_DIGEST_ARROW = pa.schema([("key", pa.string()), ("md5", pa.string())])


def dense_slices(plan: DataFrame, task_bytes: int) -> tuple[DataFrame, int]:
    """The plan with ``task`` numbers for about ``task_bytes`` each, and how many there are.

    Slices of the running total are numbered densely: a huge object leaves no empty tasks
    behind, and there are never more tasks than rows.
    """
    sliced = stored(byte_slices(plan, task_bytes), "slices")
    numbers = stored(running_totals(
        sliced.select("task").distinct(), ["task"], {"_nth": F.lit(1).cast("long")}), "numbers")
    numbered = sliced.join(numbers, "task").withColumn(
        "task", (F.col("_nth") - 1).cast("long")).drop("_nth")
    return numbered, numbers.count()


def balanced(plan: DataFrame, task_bytes: int) -> DataFrame:
    """The plan spread over tasks of about ``task_bytes`` each, however sizes are distributed."""
    numbered, tasks = dense_slices(plan, task_bytes)
    return numbered.repartitionById(max(tasks, 1), F.col("task").cast("int")).drop("task")


def _copying(
    source_root: str, target_root: str, part_bytes: int, calls: int | None, log: CheckpointLog | None,
    stop: StopFlag | None,
):
    def run(batches):
        source, target = ObjectRoot(source_root), ObjectRoot(target_root)
        inside = source.same_store(target)

        def copy(row: dict) -> dict | None:
            if stop is not None and stop.raised():
                return None
            if row.get("target_included") is False:
                return result_of(row, target_key=None, skipped=True, reason="filtered")
            if row.get("asked_version"):
                # Stores reachable through Arrow hand out the newest version only.
                return result_of(
                    row, target_key=None, success=False,
                    error=f"version {row['asked_version']!r} cannot be read from this store")
            headers = headers_of(row)
            try:
                if not (inside and not headers and source.copy_to(row["key"], target, row["target_key"])):
                    target.write(
                        row["target_key"], source.chunks(row["key"], part_bytes), headers)
            except Exception as error:  # one broken object must not stop the others
                return result_of(
                    row, target_key=None, success=False, error=str(error) or type(error).__name__)
            return result_of(row)

        yield from per_row(
            copy, RESULT_ARROW, calls or max(source.calls, target.calls), log.through if log else iter)(batches)

    return run


def copy_objects(
    plan: DataFrame, source_root: str, target_root: str, part_bytes: int = PART_BYTES,
    task_bytes: int | None = None, calls: int | None = None, split_bytes: int | None = None,
    token: str = "", log: CheckpointLog | None = None, stop: StopFlag | None = None,
) -> DataFrame:
    """Moves the bytes of each row (``key`` to ``target_key``); a failure becomes a result row.

    Bodies stream through in pieces of ``part_bytes`` and never enter a DataFrame; a task works on
    up to ``calls`` objects at once (without a number: ten on stores reached over a network, else one). With ``task_bytes`` the rows are first spread so that tasks
    carry about equal numbers of bytes. Objects longer than ``split_bytes`` are copied by their parts,
    by as many tasks as they are worth, under the run's ``token``; that part of the work is done
    at once, the rest when the result is computed. Tasks write the keys they handled to ``log``; once
    ``stop`` is raised, rows are left without a result.
    """
    large = None
    if split_bytes is not None:
        apart = (F.col("size") > split_bytes) & F.coalesce(
            F.col("target_included"), F.lit(True)) if "target_included" in plan.columns else (
            F.col("size") > split_bytes)
        large = plan.filter(F.coalesce(apart, F.lit(False)))
        plan = plan.filter(~F.coalesce(apart, F.lit(False)))
    work = balanced(plan, task_bytes) if task_bytes else plan
    small = work.mapInArrow(_copying(source_root, target_root, part_bytes, calls, log, stop), RESULT)
    if large is None or large.isEmpty():
        return small
    done, _ = copy_in_parts(
        large, source_root, target_root, token, part_bytes, calls=calls, log=log, stop=stop)
    return small.unionByName(done)


def copy_object(
    mapping: DataFrame, source_root: str, target_root: str, part_bytes: int = PART_BYTES,
    task_bytes: int | None = None,
) -> DataFrame:
    """Copies listed objects: ``source_key``, and ``target_key`` or the same key where null.

    ``task_bytes`` balances the work where the mapping has a ``size``. A row that asks for a
    ``version_id`` fails, since only the newest version can be read.
    """
    rows = mapping.select(
        F.col("source_key").alias("key"),
        F.coalesce("target_key", "source_key").alias("target_key"),
        *[c for c in ("size", "content_type", "cache_control") if c in mapping.columns],
        *[F.col(c).alias("asked_version") for c in ("version_id",) if c in mapping.columns],
    )
    return copy_objects(rows, source_root, target_root, part_bytes, task_bytes)


def delete_objects(
    orphans: DataFrame, target_root: str, calls: int | None = None
) -> DataFrame:
    """Removes each ``key`` below the target root, up to ``calls`` at once in a task."""
    def run(batches):
        target = ObjectRoot(target_root)

        def delete(row: dict) -> dict:
            try:
                target.delete(row["key"])
            except Exception as error:
                return result_of(row, success=False, error=str(error))
            return result_of(row, target_key=row["key"], reason="deleted")

        yield from per_row(delete, RESULT_ARROW, calls or target.calls)(batches)

    # Few bytes, many round trips: the keys are spread over all tasks, whatever their files.
    spread = orphans.select("key", "size").repartition(default_tasks(orphans.sparkSession))
    return spread.mapInArrow(run, RESULT)


def digest_objects(
    objects: DataFrame, root: str, part_bytes: int = PART_BYTES, calls: int | None = None
) -> DataFrame:
    """``key, md5`` of the listed objects, read in pieces; null where a body cannot be read."""
    def run(batches):
        store = ObjectRoot(root)

        def digest(row: dict) -> dict:
            md5 = hashlib.md5(usedforsecurity=False)
            try:
                for piece in store.chunks(row["key"], part_bytes):
                    md5.update(piece)
            except Exception:
                return {"key": row["key"], "md5": None}
            return {"key": row["key"], "md5": md5.hexdigest()}

        yield from per_row(digest, _DIGEST_ARROW, calls or store.calls)(batches)

    return objects.select("key").mapInArrow(run, "key string, md5 string")


def body_digests(spark: SparkSession, root: str, column_bytes: int) -> DataFrame:
    """``key, length, md5`` of every object of a store.

    The store is listed once, by tasks. Bodies of up to ``column_bytes`` become a column, many in a
    task; longer ones stream through ``digest_objects``.
    """
    # Files of a listing may be few and hold many keys.
    listed = stored(list_objects(spark, root).select("key", F.col("size").alias("length")), "listed")
    spread = listed.repartition(default_tasks(spark), "key")
    small = read_objects(spread.filter(F.col("length") <= column_bytes), root)
    long = spread.filter(F.col("length") > column_bytes)
    digests = digest_objects(long, root)
    return content_digest(small).unionByName(long.join(digests, "key").select("key", "length", "md5"))


def read_objects(objects: DataFrame, root: str) -> DataFrame:
    """``key, content`` of the listed objects; null where a body cannot be read. For short ones."""
    def run(batches):
        store = ObjectRoot(root)

        def read(row: dict) -> dict:
            try:
                return {"key": row["key"], "content": b"".join(store.chunks(row["key"], PART_BYTES))}
            except Exception:
                return {"key": row["key"], "content": None}

        yield from per_row(read, _CONTENT_ARROW, store.calls)(batches)

    return objects.select("key").mapInArrow(run, "key string, content binary")


FOLDER_NAMES = 100_000


def list_objects(
    spark: SparkSession, root: str, prefix: str = "", names_at_once: int = FOLDER_NAMES
) -> DataFrame:
    """Live listing of a store as an inventory, empty objects included.

    Folders are listed level by level, each level as one distributed job over the folders
    found before, and entries leave a task as they come, so neither the driver nor one task ever
    holds the whole listing. Only folders that can hold keys below ``prefix`` are entered. A folder
    with more than ``names_at_once`` names is left to the next level, where all tasks take a share of
    its names each, by a hash.
    """
    path = new_run_dir(spark, "listing")
    tasks = default_tasks(spark)
    folders = spark.createDataFrame([("", 0, 1)], _FOLDERS)
    level = 0
    while True:
        here = f"{path}/level={level}"
        # A given number of tasks: folder names are small, what is listed below them is not.
        spread = folders.repartition(tasks, "folder", "share") if level else folders
        spread.mapInArrow(_listing(root, prefix, names_at_once), _LISTED).write.parquet(here)
        found = spark.read.schema(_LISTED).parquet(here).filter("kind <> 'object'")
        if found.isEmpty():
            break
        shares = F.when(F.col("kind") == "large", F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(
            F.array(F.lit(0)))
        folders = found.select(
            F.col("key").alias("folder"), F.explode(shares).alias("share"),
            F.when(F.col("kind") == "large", tasks).otherwise(1).alias("shares"))
        level += 1
    files = spark.read.schema(_LISTED).option("basePath", path).parquet(path).filter("kind = 'object'")
    return files.select(
        F.lit(None).cast("string").alias("bucket"), "key",
        from_micros("mtime_us").alias("last_modified"),
        "size", F.lit(DEFAULT_STORAGE_CLASS).alias("storage_class"), F.lit("").alias("etag"),
        F.lit(None).cast("string").alias("version_id"),
    )


_FOLDERS = "folder string, share int, shares int"
_LISTED = "kind string, key string, size long, mtime_us long"


def _listing(root: str, prefix: str, most: int):
    def entries(store: ObjectRoot, folder: str, share: int, shares: int):
        def in_share(name: str) -> bool:
            return zlib.crc32(name.encode("utf-8", "surrogatepass")) % shares == share

        found = store.scan(folder, in_share) if shares > 1 else store.scan(folder)
        if shares == 1:
            first = list(islice(found, most + 1))
            if len(first) > most:
                yield "large", folder, 0, 0
                return
            found = first
        for name, is_folder, size, mtime_us in found:
            key = f"{folder}/{name}" if folder else name
            below = f"{key}/" if is_folder else key
            if below.startswith(prefix) or (is_folder and prefix.startswith(below)):
                yield "folder" if is_folder else "object", key, size, mtime_us

    def run(batches):
        store = ObjectRoot(root)
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        for batch in batches:
            for row in batch.to_pylist():
                found = entries(store, row["folder"], row["share"], row["shares"])
                while rows := list(islice(found, 10_000)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)],
                        ["kind", "key", "size", "mtime_us"])

    return run


def write_objects(bodies: DataFrame, root: str) -> DataFrame:
    """Puts ``content`` under ``key`` for each row."""
    def run(batches):
        store = ObjectRoot(root)

        def put(row: dict) -> dict:
            try:
                size = store.write(row["key"], [row["content"]])
            except Exception as error:
                return result_of(row, success=False, error=str(error))
            return result_of(row, target_key=row["key"], size=size)

        yield from per_row(put, RESULT_ARROW, store.calls)(batches)

    # A table may be few files, and its rows be read by few tasks.
    spread = bodies.select("key", "content").repartition(default_tasks(bodies.sparkSession), "key")
    return spread.mapInArrow(run, RESULT)
