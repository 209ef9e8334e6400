"""The operators as stages over ``documents``: each takes rows with the columns of that table and
returns the rows it keeps, with the same columns.

A stage keeps rows, not ids: repeated ids stay apart unless the operator says otherwise. ``n_chars``,
where present, follows the text that a stage changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import stored
from . import bpe, chunks, hyperminhash, mixing, quality

QUALITY_THRESHOLD = 0.3
SHINGLE_WORDS = 5
SIMILARITY = 0.8


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Drops the documents the classifier rejects. It learns from the labelled ones among them."""
    measured = stored(quality.with_statistics(docs), "statistics")
    forest = quality.fit(measured, labels, "quality", F.lit(True))
    rejected = quality.scored(measured, forest).filter(F.col("score") < QUALITY_THRESHOLD)
    # Rows are told apart by id and text; a null id matches a null id.
    return _without(docs, rejected.select("id", "pick"))


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    gone = dropped.withColumnsRenamed({"id": "_gone", "pick": "_pick"}).distinct()
    match = F.col("doc_id").eqNullSafe(F.col("_gone")) & (
        F.xxhash64("text", "doc_id") == F.col("_pick"))
    return docs.join(gone, match, "left_anti")


def near_dedup(docs: DataFrame) -> DataFrame:
    """Keeps of every group of near copies the one with the smallest id."""
    groups = hyperminhash.near_duplicates(docs, SHINGLE_WORDS, SIMILARITY, with_row=True)
    dropped = groups.filter(~F.col("kept")).select(
        F.col("doc_id").alias("_gone"), F.col("row").alias("_row")).distinct()
    row = F.xxhash64("text")
    left = docs.join(
        dropped, (F.col("doc_id") == F.col("_gone")) & (row == F.col("_row")), "left_anti")
    return _once(left)


def _once(docs: DataFrame) -> DataFrame:
    """Of rows with one id and text, which are copies as well, the first. Only such rows are shuffled."""
    names = docs.columns
    key = {"_id": F.col("doc_id"), "_row": F.xxhash64("text")}
    repeats = stored(docs.select(*(c.alias(n) for n, c in key.items())).groupBy("_id", "_row").count()
                     .filter("count > 1").drop("count"), "repeats")
    if repeats.isEmpty():
        return docs
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_row"))
    repeated = docs.join(repeats, match, "left_semi").withColumns(key)
    first = repeated.groupBy("_id", "_row").agg(F.first(F.struct(*names)).alias("r")).select("r.*")
    return docs.join(repeats, match, "left_anti").unionByName(first)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Cuts passages that an earlier document holds."""
    return _counted(chunks.substring_dedup(docs))


def source_mixing(docs: DataFrame) -> DataFrame:
    """The mix: whole documents as often as taken."""
    # Own names, so that columns of ``docs`` may be called like those that mixing adds.
    of = {name: f"c{k}" for k, name in enumerate(docs.columns)}
    plain = docs.toDF(*of.values())
    mixed = mixing.mix(plain, id_column=of["doc_id"], text=of["text"], source=of["source"])
    return mixing.realised(mixed, plain.columns).toDF(*of)


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Adds ``n_tokens``, ``token_ids`` (packed) and ``round_trip``, whether decoding gives the text back.
    Columns of ``docs`` with one of these names give way to them."""
    of = {name: f"c{k}" for k, name in enumerate(docs.columns)}
    plain = docs.toDF(*of.values())
    decoded = bpe.decode(
        bpe.encode(plain, path, of["text"], "_ids"), path, "_ids", "_decoded")
    kept = [F.col(c).alias(n) for n, c in of.items() if n not in ("n_tokens", "token_ids", "round_trip")]
    return decoded.select(
        *kept, (F.length("_ids") / 4).cast("long").alias("n_tokens"), F.col("_ids").alias("token_ids"),
        (F.col("_decoded") == F.coalesce(of["text"], F.lit(""))).alias("round_trip"))


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
