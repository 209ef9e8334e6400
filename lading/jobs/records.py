"""Tables that outlive a run: states, checkpoints, reports, heads and lists.

Each run writes into a folder of its own (``run=<id>``), so that writing again after a crash
replaces what the first attempt left and nothing of other runs.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.runs import last_sync_watermark
from ..plans.reports import report_json
from ..schemas import ACL, CHECKPOINT, HEAD, STATE
from ..session import remove
from .checkpoints import CheckpointLog
from .stopping import ancestors
from .store import ObjectRoot

STATES, CHECKPOINTS, REPORTS = "states", "checkpoints", "reports"
HEADS, ACLS = "heads", "acls"


def _write(rows: DataFrame, store: str, kind: str, run_id: str, batch: int = 0) -> None:
    rows.write.mode("overwrite").parquet(f"{store}/{kind}/run={run_id}/batch={batch}")


def _read(
    spark: SparkSession, store: str, kind: str, schema: T.StructType,
    inner: tuple[str, T.DataType] = ("batch", T.IntegerType()),
) -> DataFrame:
    """The table over all runs; empty where no run has written yet."""
    wide = T.StructType(schema.fields + [
        T.StructField("run", T.StringType()), T.StructField(*inner)])
    try:
        return spark.read.schema(wide).option("basePath", f"{store}/{kind}").parquet(
            f"{store}/{kind}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], wide)


def state_write(summary: DataFrame, store: str, run_id: str) -> None:
    """One state row per run.

    ``last_sync_time`` is the *start* of the run: what changes while it works is newer and
    will be seen by the next one.
    """
    row = summary.withColumn("last_sync_time", F.col("start_time"))
    _write(row.select(*STATE.names), store, STATES, run_id)


def read_states(spark: SparkSession, store: str) -> DataFrame:
    return _read(spark, store, STATES, STATE).select(*STATE.names)


def checkpoint_write(
    results: DataFrame, store: str, run_id: str, source_bucket: str, target_bucket: str,
    batch: int = 0, include_failed: bool = False,
) -> None:
    """Keys a batch has handled, from its results. Failed ones are left out, so a resumed run tries
    them again; ``include_failed`` keeps them. Copies of a run write theirs themselves
    (``CheckpointLog``)."""
    done = results if include_failed else results.filter("success")
    done.select(
        F.lit(source_bucket).alias("source_bucket"), F.lit(target_bucket).alias("target_bucket"),
        "key",
    ).write.mode("overwrite").parquet(f"{store}/{checkpoint_folder(run_id, f'batch-{batch}')}")


def checkpoint_folder(run_id: str, attempt: str) -> str:
    return f"{CHECKPOINTS}/run={run_id}/attempt={attempt}"


def checkpoint_log(
    store: str, run_id: str, source_bucket: str, target_bucket: str, every: int
) -> CheckpointLog:
    """The log of a new attempt."""
    return CheckpointLog(
        store, checkpoint_folder(run_id, uuid.uuid4().hex), source_bucket, target_bucket, every)


def checkpoint_drop(spark: SparkSession, store: str, run_id: str) -> None:
    """Forgets what earlier attempts under an id handled, for a run that begins anew."""
    remove(spark, f"{store}/{CHECKPOINTS}/run={run_id}")


def checkpoint_compact(spark: SparkSession, store: str, run_id: str) -> None:
    """Puts the many small files of a run's log together into one attempt.

    The new files are complete before the old ones go; in between keys are only listed twice.
    """
    root = ObjectRoot(store)
    folder = f"{CHECKPOINTS}/run={run_id}"
    old = [name for name, is_folder, *_ in root.scan(folder) if is_folder] if root.exists(folder) else []
    if len(old) == 1 and old[0].startswith("attempt=base"):
        return
    if old:
        rows = _checkpoints(spark, store).filter(F.col("run") == run_id).select(
            *CHECKPOINT.names).distinct()
        rows.write.parquet(f"{store}/{checkpoint_folder(run_id, 'base' + uuid.uuid4().hex)}")
        for name in old:
            remove(spark, f"{store}/{folder}/{name}")


def _checkpoints(spark: SparkSession, store: str) -> DataFrame:
    return _read(spark, store, CHECKPOINTS, CHECKPOINT, ("attempt", T.StringType()))


def read_checkpoints(spark: SparkSession, store: str, run_id: str | None = None) -> DataFrame:
    """Handled keys of all runs, or of one and those it goes on from (only their folders are read)."""
    rows = _checkpoints(spark, store)
    if run_id is not None:
        rows = rows.filter(F.col("run").isin(ancestors(store, run_id)))
    return rows.select(*CHECKPOINT.names)


def report_write(report: DataFrame, store: str, run_id: str) -> None:
    """The validation report as one JSON document."""
    report_json(report, "value").coalesce(1).write.mode("overwrite").text(
        f"{store}/{REPORTS}/run={run_id}")


def metadata_apply(heads: DataFrame, store: str, run_id: str) -> None:
    """New heads of a run; a store is fed from this table."""
    _write(_shaped(heads, HEAD), store, HEADS, run_id)


def read_heads(spark: SparkSession, store: str) -> DataFrame:
    return _read(spark, store, HEADS, HEAD)


def acl_apply(acls: DataFrame, store: str, run_id: str) -> None:
    """New access-control lists of a run."""
    _write(_shaped(acls, ACL), store, ACLS, run_id)


def read_acls(spark: SparkSession, store: str) -> DataFrame:
    return _read(spark, store, ACLS, ACL)


def _shaped(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a layout; those the rows do not have are null."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def watermark(
    spark: SparkSession, store: str, source_bucket: str, target_bucket: str,
    source_prefix: str, target_prefix: str,
) -> str | None:
    """UTC text of the last complete run between these places, or None."""
    states = read_states(spark, store).filter(
        (F.col("source_bucket") == source_bucket) & (F.col("target_bucket") == target_bucket)
        & (F.col("source_prefix") == source_prefix) & (F.col("target_prefix") == target_prefix))
    row = last_sync_watermark(states, completed_only=True).select(
        F.col("watermark").cast("string")).first()
    return row[0] if row else None
