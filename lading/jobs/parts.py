"""Objects copied and digested in parts, by as many tasks as their bytes are worth.

A copy goes through three steps. The byte ranges of all objects are dealt over tasks, each of which
reads a range and writes it to its place in the staged object; what it wrote, with a digest, is a
row of the manifest. The manifest is written before anything else happens. Then every object whose
parts all arrived becomes visible in one step, the others are removed from the stage.

A part that is copied twice, through a retry or an attempt given up, puts the same bytes into the
same place. An upload is named after its run and its object, so that retries find it and runs do not
meet; finishing an object that is finished does nothing.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..constants import PART_BYTES, USUAL_PART_MIB
from ..operators.parts import composite_etag, part_bytes_of, part_plan
from ..schemas import PART_RESULT, RESULT
from ..session import stored
from .checkpoints import CheckpointLog
from .stopping import StopFlag
from .store import ObjectRoot
from .tasks import RESULT_ARROW, default_tasks, per_row, result_of

MIB = 1024 * 1024
TASK_BYTES = 256 * MIB
_PIECE = 8 * MIB
_PART_ARROW = pa.schema([
    ("key", pa.string()), ("target_key", pa.string()), ("part_number", pa.int64()),
    ("offset", pa.int64()), ("length", pa.int64()), ("md5", pa.string()), ("error", pa.string()),
    ("task", pa.int64()),
])


def _dealt(parts: DataFrame, objects: DataFrame, task_bytes: int) -> DataFrame:
    """The parts, which are of about one size, spread over tasks of about ``task_bytes``."""
    total = objects.agg(F.sum("size")).first()[0] or 0
    tasks = max(default_tasks(parts.sparkSession), -(-total // task_bytes))
    return parts.repartition(tasks, "key", "part_number")


def _upload(token: str, target_key: str) -> str:
    return hashlib.md5(f"{token}\0{target_key}".encode(), usedforsecurity=False).hexdigest()


def copy_parts(
    objects: DataFrame, source_root: str, target_root: str, token: str,
    part_bytes: int = PART_BYTES, task_bytes: int = TASK_BYTES, calls: int | None = None,
    stop: StopFlag | None = None,
) -> DataFrame:
    """Stages the parts of each object (``key, target_key, size``); ``PART_RESULT`` rows.

    Write the rows once: computing them moves the bytes. Once ``stop`` is raised, parts are left out.
    """
    parts = part_plan(
        objects.select("key", "target_key", "size"), part_bytes_of(F.col("size"), part_bytes),
        ("target_key",))

    def run(batches):
        source, target = ObjectRoot(source_root), ObjectRoot(target_root)
        task = TaskContext.get().partitionId()

        def copy(row: dict) -> dict | None:
            if stop is not None and stop.raised():
                return None
            md5 = hashlib.md5(usedforsecurity=False)

            def pieces():
                for piece in source.ranged(row["key"], row["offset"], row["length"], _PIECE):
                    md5.update(piece)
                    yield piece

            error = None
            try:
                target.write_part(
                    row["target_key"], _upload(token, row["target_key"]), row["part_number"],
                    row["offset"], pieces())
            except Exception as problem:  # one broken part must not stop the others
                error = str(problem) or type(problem).__name__
            return {**row, "md5": None if error else md5.hexdigest(), "error": error, "task": task}

        yield from per_row(copy, _PART_ARROW, calls or max(source.calls, target.calls))(batches)

    return _dealt(parts, objects, task_bytes).mapInArrow(run, PART_RESULT)


def finish_parts(
    objects: DataFrame, manifest: DataFrame, target_root: str, token: str,
    calls: int | None = None, log: CheckpointLog | None = None,
) -> DataFrame:
    """``RESULT`` rows of the staged objects: each appears whole, or its stage is removed.

    An object of which a part was left out, because the run stopped, has no result and stays staged.
    """
    arrived = manifest.groupBy("key", "target_key").agg(
        F.count("*").alias("parts"), F.min("error").alias("error"),
        F.sum("length").alias("staged")
    ).join(
        objects.select("key", "target_key", F.coalesce("size", F.lit(0)).alias("_size")),
        ["key", "target_key"]).filter("staged = _size or error is not null").drop("_size")
    extra = [c for c in ("content_type", "cache_control") if c in objects.columns]
    rows = objects.select("key", "target_key", "size", *extra).join(arrived, ["key", "target_key"])

    def run(batches):
        target = ObjectRoot(target_root)

        def finish(row: dict) -> dict:
            upload = _upload(token, row["target_key"])
            try:
                if row["error"] is not None:
                    target.abort(row["target_key"], upload)
                    return result_of(row, target_key=None, success=False, error=row["error"])
                target.finish(
                    row["target_key"], upload, row["parts"], row["staged"], _PIECE, headers_of(row))
            except Exception as problem:
                return result_of(
                    row, target_key=None, success=False,
                    error=str(problem) or type(problem).__name__)
            return result_of(row)

        yield from per_row(finish, RESULT_ARROW, calls or target.calls, log.through if log else iter)(batches)

    return rows.mapInArrow(run, RESULT)


def headers_of(row: dict) -> dict[str, str]:
    """Headers of a written object, as far as the row has them."""
    return {
        name: row.get(column) for name, column in
        (("Content-Type", "content_type"), ("Cache-Control", "cache_control")) if row.get(column)
    }


def copy_in_parts(
    objects: DataFrame, source_root: str, target_root: str, token: str,
    part_bytes: int = PART_BYTES, task_bytes: int = TASK_BYTES, calls: int | None = None,
    log: CheckpointLog | None = None, stop: StopFlag | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Copies each object by all its parts: ``RESULT`` rows, lazy, and the written manifest."""
    manifest = stored(copy_parts(
        objects, source_root, target_root, token, part_bytes, task_bytes, calls, stop), "parts")
    return finish_parts(objects, manifest, target_root, token, calls, log), manifest


def manifest_etags(manifest: DataFrame) -> DataFrame:
    """``key, target_key, etag, n_parts`` of the objects whose parts all arrived."""
    whole = manifest.groupBy("key", "target_key").agg(F.count("error").alias("errors")).filter(
        "errors = 0").drop("errors")
    return composite_etag(
        manifest.join(whole, ["key", "target_key"], "left_semi"), "key", "target_key")


def part_digests(
    objects: DataFrame, root: str, task_bytes: int = TASK_BYTES, calls: int | None = None,
) -> DataFrame:
    """``key, each, part_number, md5`` of the parts of ``objects`` (``key, size, each``: the size of a
    part); a digest is null where its range cannot be read."""
    parts = part_plan(objects, F.col("each"), ("each",))

    def run(batches):
        store = ObjectRoot(root)

        def digest(row: dict) -> dict:
            md5 = hashlib.md5(usedforsecurity=False)
            try:
                for piece in store.ranged(row["key"], row["offset"], row["length"], _PIECE):
                    md5.update(piece)
            except Exception:
                return {**row, "md5": None}
            return {**row, "md5": md5.hexdigest()}

        yield from per_row(digest, arrow, calls or store.calls)(batches)

    arrow = pa.schema([
        ("key", pa.string()), ("each", pa.int64()), ("part_number", pa.int64()), ("md5", pa.string())])
    return _dealt(parts, objects, task_bytes).mapInArrow(
        run, "key string, each long, part_number long, md5 string")


def part_sizes(length, parts, unit: int = MIB, usual: tuple[int, ...] = USUAL_PART_MIB):
    """The part sizes that can give an object of ``length`` bytes ``parts`` parts: the usual ones that
    do, the least that does, and the least whole multiple of ``unit`` that does.

    Columns in, an array out; at most ``len(usual) + 2`` sizes.
    """
    least = F.greatest(F.lit(1).cast("long"), F.ceil(length / parts).cast("long"))
    rounded = (F.ceil(least / unit) * unit).cast("long")
    tried = F.array(*[F.lit(u * unit).cast("long") for u in usual], least, rounded)
    return F.array_distinct(F.filter(
        tried, lambda each: F.greatest(F.lit(1), F.ceil(length / each)) == parts))


def composite_digests(
    cases: DataFrame, root: str, unit: int = MIB, usual: tuple[int, ...] = USUAL_PART_MIB,
    task_bytes: int = TASK_BYTES, calls: int | None = None,
) -> DataFrame:
    """``key, etags``: what composite ETag the body of each key (``key, size, parts``) can have.

    The parts of all possible sizes are read by separate tasks and their digests combined.
    """
    sized = cases.select("key", F.coalesce("size", F.lit(0)).alias("size"), "parts")
    tried = stored(sized.select("key", "size", F.explode(
        part_sizes(F.col("size"), F.col("parts"), unit, usual)).alias("each")), "tried")
    digests = stored(part_digests(tried, root, task_bytes, calls), "digests")
    unread = digests.filter("md5 is null").select("key").distinct()
    found = composite_etag(digests.join(unread, "key", "left_anti"), "key", "each")
    # One part has a composite ETag too, where it came as an upload of parts.
    single = F.concat(F.md5(F.unhex("etag")), F.lit("-1"))
    return found.withColumn("etag", F.when(F.col("n_parts") == 1, single).otherwise(F.col("etag"))).groupBy(
        "key").agg(F.collect_set("etag").alias("etags"))
