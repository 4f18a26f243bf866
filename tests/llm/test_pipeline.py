"""The whole pipeline against a plain version, and every registered query."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from reachbook.llm.mixing import mix_sources
from reachbook.llm.packing import Encoder, Vocabulary, cut
from reachbook.llm.quality_rules import Bands, Judge, judge_text
from reachbook.llm.secrets import redact
from tests.llm.helpers import SCHEMA, documents, edge_rows, prose
from tests.llm.test_joins import Groups, shingles


def corpus() -> list[tuple]:
    rows = [(i, prose(i, 70 + i), "en", f"s{i % 4}") for i in range(40)]
    for i in range(8):  # near copies, exact copies
        words = rows[i][1].split()
        rows.append((100 + i, " ".join(words[:-1] + ["changed"]), "en", "s9"))
        rows.append((200 + i, rows[i][1], "en", None))
    rows.append((300, prose(300, 90) + ' password = "hunter2hunter2X9"', "en", "s1"))
    rows.append((301, "word " * 200, "en", "s1"))
    rows.append((302, prose(302, 12), "en", "s1"))
    return rows


def plain_kept(rows: list[tuple]) -> list[tuple]:
    """Rules, then the smallest of each group of near copies, then masks."""
    judge = Judge(Bands())
    kept = [r for r in rows if judge_text(r[1] or "", judge).kept]
    sets = {r[0]: shingles(r[1], 5) for r in kept}
    groups = Groups(sets)
    for a, one in sets.items():
        for b, two in sets.items():
            if a < b and 100 * len(one & two) >= 80 * len(one | two):
                groups.join(a, b)
    return [(d, redact(t), lang, s) for d, t, lang, s in kept if groups.root(d) == d]


def test_pipeline_is_its_plain_version(spark, tmp_path):
    rows = corpus()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = plain_kept(rows)
    assert {300} <= {d for d, *_ in kept} and not {100, 200, 301, 302} & {d for d, *_ in kept}
    copies = {r.doc_id: r.copies for r in mix_sources(documents(spark, kept)).collect()}
    encoder = Encoder(Vocabulary())
    wanted = Counter()
    for doc, text, *_ in kept:
        for number, (start, length) in enumerate(cut(len(encoder(text)) + 1, 1024)):
            wanted[doc, number, start, length] += copies[doc]
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in found) == +wanted
    filled = Counter()
    for r in found:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    docs = documents(spark, corpus())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == documents(spark, []).columns
    assert "[SECRET]" in docs.where("doc_id = 300").first().text
    assert all(len(r.text) == r.n_chars for r in docs.collect())


def test_pipeline_edges(spark, tmp_path):
    documents(spark, edge_rows() + [(50, prose(50, 80)), (50, prose(50, 80))]).write.parquet(f"{tmp_path}/some/documents.parquet")
    found = {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/some").collect()}
    assert 1 in found and 2 not in found and 3 not in found
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_rows_that_share_an_id(spark):
    one, two = prose(1, 90), prose(2, 90)
    rows = [(7, one), (7, two), (7, one), (None, one + " x"), (None, prose(3, 90)), (None, prose(3, 90)), (4, two + " y"), (8, None), (8, "")]
    found = corpus_pipeline.one_of_each(spark, documents(spark, rows).withColumn("row", F.lit(1)), "")
    assert found.columns == [*documents(spark, []).columns, "row"]
    kept = Counter((r.doc_id, r.text) for r in found.collect())
    assert kept == Counter([(7, one), (4, two + " y"), (None, prose(3, 90)), (8, None), (8, "")])


@pytest.mark.parametrize("number", range(1, 14))
def test_a_query_is_registered_per_operator(number):
    assert sum(name.startswith(f"op{number}_") for name in entry_points.queries()) == 1
    assert "pipeline" in entry_points.queries()
