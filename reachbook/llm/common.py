"""Shared steps: stored intermediates, Arrow batches, words, hashing, components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reachbook.session import shared_folder

#: The bytes of `[\x20\x09-\x0D]`; bytes.split() and bytes.strip() use the same ones.
SPACE = b" \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written to the checkpoint folder: later reads neither
    repeat the work nor depend on an executor that may be lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The same rows as a Parquet table in the checkpoint folder."""
    return Scratch(df.sparkSession).written(df)


class Scratch:
    """Tables that are only needed until a result made of them is written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{uuid.uuid4()}"
        self.tables = 0
        self.names: list[str] = []

    def written(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.tables}"
        self.tables += 1
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def bucketed(self, df: DataFrame, column: str, buckets: int) -> DataFrame:
        """The same rows, written in buckets of a column where they are: a join on
        it need not shuffle them any more."""
        name = f"scratch_{uuid.uuid4().hex}"
        writer = df.write.option("compression", "zstd").bucketBy(buckets, column)
        writer.option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def clear(self) -> None:
        """Delete them: no lineage may lead to them any more."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of stored tables now. It does so once
    the driver has collected the plans they came from, which else may take long
    after the disk is full."""
    gc.collect()
    spark._jvm.System.gc()


def numbered_rows(df: DataFrame, name: str = "row") -> DataFrame:
    """The rows with a number each, written down, as another reading could number
    them otherwise. Ids may be null or shared; these numbers are not."""
    return written(df.withColumn(name, F.monotonically_increasing_id()))


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """Each value once, in order, by sorting: np.unique hashes, which takes longer."""
    values = np.sort(values)
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return values[first]


def in_batches(
    df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, rows: int = 256
) -> DataFrame:
    """Apply `step` to small Arrow batches, so memory follows the longest texts
    of a few rows and not a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = step(batch.slice(start, rows))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def per_text(df: DataFrame, key: str, text: str, columns: dict[str, pa.DataType], step: Callable[[str], tuple]) -> DataFrame:
    """One row per document: its key, as a long, and what `step` says of its text
    (null: empty). Other columns are left behind, so none can clash."""
    names = list(columns)
    types = list(columns.values())
    spark_names = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string", pa.float64(): "double"}
    schema = ", ".join([f"{key} long", *[f"{n} {spark_names[t]}" for n, t in columns.items()]])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [step(t or "") for t in batch.column(1).to_pylist()]
        arrays = [pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], [key, *names])

    return in_batches(df.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("text")), run, schema)


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, packed): texts as compressed UTF-8, to be shuffled."""
    held: list[zstandard.ZstdCompressor] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(zstandard.ZstdCompressor(level=3))
        data = [held[0].compress((t or "").encode()) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "packed"])

    return in_batches(docs.select("doc_id", "text"), step, "doc_id long, packed binary")


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch whose second column is compressed text."""
    unpack = zstandard.ZstdDecompressor()
    for doc, packed, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        yield doc, unpack.decompress(packed), *rest


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of edges (a, b): the smallest id reachable.

    Each round links every vertex to the least id it knows, then those to their
    own least: long chains halve. Least ids are summed up before the shuffle and
    stored before they are joined, so adaptive execution can split a vertex with
    a third of all edges. Stops when every edge leads to a component's least id.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct())
    release(edges.sparkSession)
    while True:
        # Every vertex: its larger neighbours go to the least one it knows.
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        wide = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        wide = stored(wide.where("a <> b").distinct())
        # Every vertex: it and its smaller neighbours go to the least of those.
        least = stored(wide.groupBy("a").agg(F.min("b").alias("m")))
        near = wide.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        near = near.unionAll(least.select("a", F.col("m").alias("b")))
        after = stored(near.where("a <> b").distinct())
        if _same(edges, after):
            roots = after.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
            return after.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)
        edges = after


def _same(one: DataFrame, other: DataFrame) -> bool:
    """Distinct edges are the same, by count and by two sums of their hashes."""
    sums = [
        F.count("*"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        F.sum(F.xxhash64("b", "a", F.lit(1)).cast("decimal(38,0)")),
    ]
    return one.agg(*sums).first() == other.agg(*sums).first()
