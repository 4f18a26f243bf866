"""Exact-day snapshot lookups, area lookup and first-row-per-group picks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AREA = ("Provinsi", "Kab", "Kec", "Desa")
# Area columns in the order used to settle ties, which is the report's order.
AREA_ORDER = ("Provinsi", "Desa", "Kab", "Kec")


def snapshot_lookup(df: DataFrame, snapshots: DataFrame, day: Column, columns: dict[str, str]) -> DataFrame:
    """Attach snapshot columns (new name: source name) of exactly the given day.

    A left join on cleaned agreement number and day: rows without a snapshot
    stay, with NULLs, and duplicate snapshots multiply rows.
    """
    attached = [f"`{source}` as `{name}`" for name, source in columns.items()]
    right = snapshots.selectExpr("agreement_key as _key", "ReportDate as _day", *attached)
    matches = (F.col("agreement_key") == F.col("_key")) & (day == F.col("_day"))
    return df.join(right, matches, "left").drop("_key", "_day")


def area_lookup(df: DataFrame, areas: DataFrame) -> DataFrame:
    """Attach the area columns of the agreement, NULL where it has none."""
    right = areas.selectExpr("agreement_key as _key", *AREA)
    return df.join(right, F.col("agreement_key") == F.col("_key"), "left").drop("_key")


def best_area(areas: DataFrame) -> DataFrame:
    """One area per agreement, the first in tie-break order."""
    first = F.min(F.struct(*AREA_ORDER)).alias("area")
    return areas.groupBy("agreement_key").agg(first).select("agreement_key", "area.*")


def hash_first(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys behind their hash, for groups found by sorting: rows then sort
    by one number and hardly ever by text. Collated keys are left as they are,
    because equal ones may hash differently."""
    types = {field.name: field.dataType for field in df.schema}
    if any(isinstance(types[k], T.StringType) and types[k] != T.StringType() for k in keys):
        return list(keys)
    return [f"xxhash64({', '.join(keys)})", *keys]


def numbered(
    df: DataFrame, keys: Sequence[str], leading: Sequence[str], name: str, *, skip: Sequence[str] = ()
) -> DataFrame:
    """Number the rows of each group by the leading sort terms, then by every
    other column but the skipped ones, NULLs first.

    Only rows equal in every column can tie, so a number is the same on any plan.
    """
    return _numbered(df, keys, keys, leading, name, skip)


def _numbered(df, keys, partition, leading, name, skip) -> DataFrame:
    rest = [f"`{c}` asc nulls first" for c in df.columns if c not in (*keys, *skip)]
    number = f"row_number() over (partition by {', '.join(partition)} order by {', '.join([*leading, *rest])})"
    return df.withColumn(name, F.expr(number))


def first_of_group(
    df: DataFrame, keys: Sequence[str], leading: Sequence[str], name: str, *, skip: Sequence[str] = ()
) -> DataFrame:
    """Row 1 of each group. Spark cuts every input partition to one row per
    group before the shuffle, so a huge group costs no more than a small one."""
    return _numbered(df, keys, hash_first(df, keys), leading, name, skip).where(F.col(name) == 1)


def numbered_in_parts(
    df: DataFrame,
    keys: Sequence[str],
    leading: Sequence[str],
    name: str,
    *,
    coarse: str | None = None,
    skip: Sequence[str] = (),
) -> DataFrame:
    """`numbered` for groups too large for one task.

    The leading terms, and after them `coarse`, cut a group into parts that
    follow each other: `coarse` is an expression that never falls along the
    order of the columns that come next. Rows are numbered within their part, in
    as many tasks as there are parts; counts of the parts, summed up before the
    shuffle, tell where each part starts.
    """
    shown = df.columns
    terms, skip = list(leading), list(skip)
    if coarse:
        df = df.withColumn("_coarse", F.expr(coarse))
        terms.append("_coarse asc nulls first")
    columns = [term.split()[0] for term in terms]
    starts = (
        df.groupBy(*keys, *columns)
        .count()
        .withColumn(
            "_before",
            F.expr(
                f"sum(count) over (partition by {', '.join(keys)} order by {', '.join(terms)}"
                " rows between unbounded preceding and 1 preceding)"
            ),
        )
        .select(*[F.col(c).alias(f"_{c}") for c in (*keys, *columns)], F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    within = numbered(df, [*keys, *columns], [f"{keys[0]} asc"], "_within", skip=skip)
    same_part = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, *columns)])
    number = (F.col("_before") + F.col("_within")).alias(name)
    return within.join(starts, same_part).select(*[f"`{c}`" for c in shown], number)


# Numbers that one row of counts turns into at once.
BLOCK = 10_000


def numbered_by_counts(df: DataFrame, keys: Sequence[str], last: str, name: str) -> DataFrame:
    """Number rows that hold nothing but the keys and one more column, by that
    column, NULLs first.

    Equal rows differ in their number only, so counts say it all: no row is
    moved but the counts, one per group and value. They are dealt out in blocks,
    so the numbers of a huge group come from many tasks.
    """
    before = (
        f"coalesce(sum(count) over (partition by {', '.join(keys)} order by {last} asc nulls first"
        " rows between unbounded preceding and 1 preceding), 0)"
    )
    counts = df.groupBy(*keys, last).count().withColumn("_before", F.expr(before))
    blocks = counts.withColumn("_block", F.explode(F.expr(f"sequence(0, (count - 1) div {BLOCK})")))
    dealt = blocks.repartition(*keys, last, "_block")
    numbers = f"sequence(_block * {BLOCK} + 1, least(count, (_block + 1) * {BLOCK}))"
    return dealt.select(*keys, last, "_before", F.explode(F.expr(numbers)).alias("_n")).select(
        *df.columns, (F.col("_before") + F.col("_n")).alias(name)
    )


def _sort_columns(terms: Sequence[str]) -> list[Column]:
    """Sort terms such as `name desc nulls last` as columns."""
    columns = []
    for term in terms:
        name, *how = term.rsplit(None, 3) if len(term.split()) > 3 else term.split()
        columns.append(getattr(F.col(name), "_".join(how) if how else "asc")())
    return columns


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Equal rows as one with its `_copies`, dealt out by ranges of the groups and
    their order; `_part` is the range. The number of ranges is set, so adaptive
    execution leaves them as they are."""
    kinds = [field.dataType for field in df.schema]
    columns = [f"`{c}`" for c in df.columns]
    if all(not isinstance(kind, T.StringType) or kind == T.StringType() for kind in kinds):
        df = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    else:  # under a collation, rows that are grouped need not be the same
        df = df.withColumn("_copies", F.lit(1).cast("long"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*[F.col(k).asc_nulls_first() for k in keys], *_sort_columns(order)]
    return df.repartitionByRange(ranges, *by).withColumn("_part", F.spark_partition_id())


def numbered_by_ranges(
    df: DataFrame, keys: Sequence[str], leading: Sequence[str], name: str, *, skip: Sequence[str] = ()
) -> DataFrame:
    """`numbered` for groups of any size, whatever their rows have in common.

    Rows are dealt out by ranges of group and full order, so a huge group lies in
    several ranges that follow each other. Each range numbers its own rows; counts
    per group and range say where it goes on. Both read one shuffle. Should a
    session forbid that, their counts would differ, and the query fails instead
    of giving a wrong number.
    """
    order = [*leading, *[f"`{c}` asc nulls first" for c in df.columns if c not in (*keys, *skip)]]
    ranged = _ranged(df, keys, order)
    group = ", ".join(keys)
    before = "rows between unbounded preceding and 1 preceding"
    starts = ranged.groupBy(*keys, "_part").agg(F.sum("_copies").alias("_size"))
    starts = starts.withColumn("_start", F.expr(f"coalesce(sum(_size) over (partition by {group} order by _part {before}), 0)"))
    starts = starts.select(*[F.col(c).alias(f"_{c}") for c in (*keys, "_part")], F.col("_size").alias("_counted"), "_start")
    own = f"partition by {group}, _part"
    within = ranged.withColumns(
        {
            "_within": F.expr(f"coalesce(sum(_copies) over ({own} order by {', '.join(order)} {before}), 0)"),
            "_size": F.expr(f"sum(_copies) over ({own})"),
        }
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, "_part")])
    apart = F.raise_error(F.lit("numbering needs spark.sql.exchange.reuse"))
    met = within.join(starts, same, "left").withColumn(
        "_start", F.when(F.col("_size") == F.col("_counted"), F.col("_start")).otherwise(apart.cast("long"))
    )
    # Copies are dealt out in blocks, so those of one row come from many tasks.
    blocks = met.withColumn("_block", F.explode(F.expr(f"sequence(0, (_copies - 1) div {BLOCK})")))
    dealt = blocks.repartition(*keys, "_part", "_within", "_block")
    numbers = f"sequence(_block * {BLOCK} + 1, least(_copies, (_block + 1) * {BLOCK}))"
    number = (F.col("_start") + F.col("_within") + F.col("_n")).cast("int").alias(name)
    return dealt.withColumn("_n", F.explode(F.expr(numbers))).select(*[f"`{c}`" for c in df.columns], number)
