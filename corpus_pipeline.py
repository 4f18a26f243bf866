"""Documents to training sequences: rules, one of each near copy, secrets
masked, sources mixed, sequences packed."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachbook.llm.common import in_batches, numbered_rows, table, written
from reachbook.llm.jaccard import Join, jaccard_rows
from reachbook.llm.mixing import mix_sources
from reachbook.llm.packing import pack, pieces
from reachbook.llm.quality_rules import Bands, Judge, judge_text
from reachbook.llm.secrets import Scoring, redact

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: SQL has no zstandard, tokenizer or lexer: tests hold run() against a plain version.
ORACLE_SQL = None

#: Near copies share 80 % of their distinct 5-word shingles.
NEAR = Join(words=5, percent=80)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, unmoved. Null and empty texts
    are rejected; repeated rows are judged alike; no rows give no rows."""
    held: list[Judge] = []
    at = docs.columns.index("text")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Judge(Bands()))
        kept = [judge_text(t or "", held[0]).kept for t in batch.column(at).to_pylist()]
        return batch.filter(pa.array(kept, pa.bool_()))

    return in_batches(docs, step, docs.schema)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Each row is a document, so rows that share an id stay if their texts are no
    near copies, and of equal rows one stays. A row without an id stays if its
    group has none that has one. Where ids tie, a hash of the whole row decides.
    Texts without a word are no copies of each other.
    """
    number = "row"
    while number in docs.columns:
        number += "_"
    rows = numbered_rows(docs, number)
    ids = F.col("doc_id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.col("doc_id").isNull().alias("a"), ids[0].alias("b"), ids[1].alias("c"), F.col(number).alias("d"))
    found = jaccard_rows(rows.select(F.col(number).alias("doc_id"), "text"), NEAR)
    found = found.select(F.col("doc_id").alias(number), "component_id").join(rows.select(number, order.alias("order")), number)
    chosen = found.groupBy("component_id").agg(F.min("order").alias("order")).select(F.col("order.d").alias(number))
    return rows.join(chosen, number, "left_semi").drop(number)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked and `n_chars` to match. Null and
    empty texts stay as they are; repeated rows are masked alike."""
    scoring = Scoring()
    text_at, size_at = docs.columns.index("text"), docs.columns.index("n_chars")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text_at).to_pylist()
        masked = [t if t is None else redact(t, scoring) for t in texts]
        sizes = [
            size if old == new else len(new)
            for old, new, size in zip(texts, masked, batch.column(size_at).to_pylist(), strict=True)
        ]
        columns = list(batch.columns)
        columns[text_at] = pa.array(masked, columns[text_at].type)
        columns[size_at] = pa.array(sizes, columns[size_at].type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return in_batches(docs, step, docs.schema)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Rows that share an id share
    its draw; those without one are taken once."""
    copies = mix_sources(docs).where("doc_id is not null").groupBy("doc_id").agg(F.max("copies").alias("copies"))
    taken = docs.join(copies.where("copies > 0"), "doc_id")
    repeated = taken.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)
    return repeated.unionByName(docs.where("doc_id is null"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of each document with its training sequence and its place there.
    A null text is empty, and an empty one is its end mark; repeated rows are
    packed as often as they are there; no rows give no rows."""
    return pack(pieces(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_by_rules),
    ("ngram_jaccard_join", one_of_each),
    ("secret_scans", mask_secrets),
    ("source_mixing", mix),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
