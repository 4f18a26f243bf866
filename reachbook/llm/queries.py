"""Registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachbook.llm.collocations import collocations
from reachbook.llm.common import table
from reachbook.llm.fill_middle import fill_middle, restored
from reachbook.llm.jaccard import Join, jaccard_components
from reachbook.llm.language_id import language_id
from reachbook.llm.line_dedup import line_dedup
from reachbook.llm.mixing import mix_sources
from reachbook.llm.packing import pack, pieces
from reachbook.llm.personal_data import personal_data
from reachbook.llm.quality_rules import quality_rules
from reachbook.llm.range_join import range_join
from reachbook.llm.secrets import secret_scan
from reachbook.llm.site_quality import site_quality
from reachbook.llm.suffix_dedup import suffix_dedup


def op1_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_join(table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op8_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"), Join(words=3, percent=90))
    return found.withColumnRenamed("n_grams", "n_shingles")


def op10_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_range_join,
        op2_quality_rules,
        op3_mix_sources,
        op4_secret_scan,
        op5_language_id,
        op6_suffix_dedup,
        op7_personal_data,
        op8_site_quality,
        op9_jaccard_join,
        op10_best_two_fit,
        op11_line_dedup,
        op12_collocations,
        op13_fill_middle,
    )
}

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_LINE_DEDUP = f"""
with docs as (
    select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), line as (
    select r, unnest(lines) as line, unnest(range(len(lines))) as i from docs
), keyed as (
    select r, i, line,
        trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_BLANKS}) as k
    from line
), frequent as (
    select k from keyed where k <> '' group by k having count(distinct r) >= 10
), kept as (
    select r, string_agg(line, chr(10) order by i) as text, count(*) as n
    from keyed where k not in (select k from frequent) group by r
)
select doc_id, cast(len(lines) as bigint) as n_lines, cast(len(lines) - coalesce(n, 0) as bigint) as n_dropped,
    sha256(coalesce(kept.text, '')) as kept_sha256
from docs left join kept using (r)
"""

_COLLOCATIONS = """
with docs as (
    select coalesce(lang, 'und') as lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
    from documents
), piece as (
    select lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) as p from docs
), word as (
    select lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') as w from piece
), total as (
    select lang, cast(sum(len(w)) as bigint) as n from word group by lang
), gram as (
    select lang, words, unnest(list_transform(range(1, len(w) - words + 2), lambda i: array_to_string(w[i:i + words - 1], ' '))) as phrase
    from word, unnest([1, 2, 3, 4]) as sizes(words)
), counted as (
    select lang, words, phrase, count(*) as f from gram group by all having count(*) >= 30
), split as (
    select lang, words, phrase, f, string_split(phrase, ' ') as w from counted
), cut as (
    select lang, words, phrase, f as a, w, unnest(range(1, words)) as k from split where words > 1
), scored as (
    select c.lang, c.phrase, c.a, c.k, h.f as l, t.f as r,
        (cast(2000000 as hugeint) * c.a) // (cast(h.f as hugeint) + t.f) as score
    from cut c
    join counted h on h.lang = c.lang and h.phrase = array_to_string(c.w[1:c.k], ' ')
    join counted t on t.lang = c.lang and t.phrase = array_to_string(c.w[c.k + 1:c.words], ' ')
), lowest as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_phrase as (
    select lang, f, unnest(list_transform(range(1, words - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase
    from split, unnest([2, 3]) as sizes(size) where size < words
), longer as (
    select lang, phrase, max(f) as f from inner_phrase group by all
), ranked as (
    select s.*, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from lowest s left join longer using (lang, phrase)
    where longer.f is null or cast(100 as hugeint) * longer.f < cast(80 as hugeint) * a
)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score
from ranked join total using (lang) where rank <= 2000
"""

_TOKENS = "[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+"

_FILL_MIDDLE = f"""
with docs as (
    select doc_id, coalesce(text, '') as text, sha256('42:' || cast(doc_id as varchar)) as h,
        regexp_extract_all(coalesce(text, ''), '{_TOKENS}') as tokens
    from documents
), drawn as (
    select *, cast(len(tokens) as bigint) as n,
        cast('0x' || h[1:8] as ubigint) as h1, cast('0x' || h[9:16] as ubigint) as h2,
        cast('0x' || h[17:24] as ubigint) as h3, cast('0x' || h[25:32] as ubigint) as h4
    from docs
), cut as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50
            then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form
    from drawn
), parts as (
    select *, array_to_string(tokens[1:a], '') as prefix, array_to_string(tokens[a + 1:b], '') as middle,
        array_to_string(tokens[b + 1:n], '') as suffix
    from cut
)
select doc_id, n, form,
    case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
    case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from parts
"""

#: DuckDB SQL by query, where SQL can express it.
ORACLE_SQL: dict[str, str] = {"op11_line_dedup": _LINE_DEDUP, "op12_collocations": _COLLOCATIONS, "op13_fill_middle": _FILL_MIDDLE}
