"""A listing stored in key order, with an index of its files, for pages that open few of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import PAGE_KEYS
from .inventory import page_rows

ROWS_PER_FILE = 1_000_000
_INDEX = "file string, first string, last string, rows long"


def write_page_index(inventory: DataFrame, path: str, files: int | None = None) -> None:
    """Writes the listing below ``path``, sorted by key over ``files``, and one index row for each."""
    files = files or max(1, -(-inventory.count() // ROWS_PER_FILE))
    inventory.repartitionByRange(files, "key").sortWithinPartitions("key").write.parquet(f"{path}/rows")
    listed = inventory.sparkSession.read.schema(inventory.schema).parquet(f"{path}/rows")
    listed.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("rows")
    ).coalesce(1).write.parquet(f"{path}/index")


def _after(prefix: str) -> str:
    """A text that every key with the prefix stands before."""
    return prefix + "\U0010ffff"


def indexed_page(
    spark: SparkSession, path: str, prefix: str = "", delimiter: str | None = None,
    max_keys: int = PAGE_KEYS, continuation_token: str | None = None,
) -> DataFrame:
    """``list_page`` of a stored listing; only files that can hold rows of the page are opened.

    Files are taken in key order until they hold the page. Where a file begins before the token, or
    a delimiter rolls keys up, how many of its rows count is only known when it is read; then more
    are taken, each time twice as many.
    """
    token = max(continuation_token or "", prefix)
    index = spark.read.schema(_INDEX).parquet(f"{path}/index").filter(
        (F.col("last") >= token) & (F.col("first") <= _after(prefix))).orderBy("first", "last")
    schema = spark.read.parquet(f"{path}/rows").schema
    count = 2
    while True:
        # One row for each file of the page, and one more.
        files = index.limit(count + 1).collect()
        rows = spark.read.schema(schema).parquet(*[f["file"] for f in files[:count]]) if files else (
            spark.createDataFrame([], schema))
        page = page_rows(rows, prefix, delimiter, max_keys, continuation_token)
        if len(files) <= count or page.count() > max_keys:
            return page.limit(max_keys)
        count *= 2

