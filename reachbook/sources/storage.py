"""Tables stored for the reports: bucketed by agreement, partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Joins on agreement and day then use a layout by agreement alone.
BUCKETED_JOINS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def store_bucketed(
    df: DataFrame, table: str, buckets: int, *, day: str | None = None, path: str | None = None, mode: str = "errorifexists"
) -> None:
    """Save a table in buckets of agreements, and in partitions of a day column.

    Adds `agreement_key`, the agreement number without blanks around it, which is
    what nearly all joins match; reading the table back, the campaign takes it as
    it is. Sorted within its files, so reading part of the agreements skips pages.
    Use the same number of buckets for all tables, and `use_buckets` on the session.
    """
    number = next(c for c in df.columns if c.lower() == "agreementno")
    keyed = df.withColumn("agreement_key", F.trim(F.col(number)))
    # One task per bucket writes its files, not every task some of each.
    dealt = keyed.repartition(buckets, "agreement_key")
    writer = dealt.write.mode(mode).bucketBy(buckets, "agreement_key").sortBy("agreement_key")
    if day:
        writer = writer.partitionBy(day)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def use_buckets(spark: SparkSession) -> SparkSession:
    """Let joins that match more than the agreement read buckets unshuffled."""
    for name, value in BUCKETED_JOINS.items():
        spark.conf.set(name, value)
    return spark
