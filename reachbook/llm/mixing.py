"""Mixing sources to target weights by Pareto order sampling.

A source's target is met by whole copies of all its documents, which are
certain, and a sample for the rest. In the sample longer documents are likelier
(by the square root of their size). Documents are ranked by random odds divided
by the odds of their inclusion, and the first ones that fill the rest are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachbook.llm.common import stored

WORDS = r"[^\x20\x09-\x0D]+"


def source_sizes(sizes: DataFrame) -> DataFrame:
    """(_key, _number, source_size): sources numbered in order, in parts, so that
    their number does not matter."""
    totals = sizes.groupBy("_key").agg(F.sum("size").alias("source_size"))
    dealt = stored(totals.repartitionByRange("_key").withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_part").count()
    # One row per partition.
    before = F.sum("count").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("count")
    starts = counts.select("_part", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_key")) - 1
    return dealt.withColumn("_within", within).join(starts, "_part").select(
        "_key", (F.col("_before") + F.col("_within")).alias("_number"), "source_size"
    )


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Each source's target: its weight's part of `share` times all sizes, at
    most `most` times its own size; what is above goes to the others by weight.

    All sources below their limit get the same amount per unit of weight. That
    level only rises as more sources reach their limit, so it is found from a
    few sums over the sources.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = stored(sources.withColumn("_weight", F.get(cycle, F.pmod("_number", F.lit(len(weights))))))
    total, weight = sources.agg(F.sum("source_size"), F.sum("_weight")).first()
    level = share * total / weight if weight else 0.0
    while True:
        full = F.col("source_size") * F.lit(most) < F.col("_weight") * F.lit(level)
        given, weight = sources.agg(
            F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("_weight")))
        ).first()
        after = max(level, (share * total - most * (given or 0)) / weight) if weight else level
        if after == level:
            break
        level = after
    target = F.least(F.col("source_size") * F.lit(float(most)), F.col("_weight") * F.lit(level))
    return sources.select("_key", "source_size", target.cast("double").alias("target"))


def _inclusion(sizes: DataFrame, rest: DataFrame) -> DataFrame:
    """(_key, _scale): the factor by which a size's root gives its inclusion
    probability, so that the expected words are the rest.

    Sizes from some point on are certain. With the certain ones fixed the factor
    follows from sums; the right one is the first that leaves the next size below 1.
    """
    by_size = sizes.where("size > 0").groupBy("_key", "size").count().join(rest, "_key")
    larger = Window.partitionBy("_key").orderBy(F.desc("size"))
    words = F.col("size") * F.col("count")
    weighed = words * F.sqrt("size")
    sure = F.sum(words).over(larger) - words
    open_weight = F.sum(weighed).over(Window.partitionBy("_key").orderBy("size"))
    scale = (F.col("_rest") - sure) / open_weight
    return (
        by_size.select("_key", "size", scale.alias("_scale"))
        .where(F.col("_scale") * F.sqrt("size") <= 1)
        .groupBy("_key")
        .agg(F.max_by("_scale", "size").alias("_scale"))
    )


def _cut(ranked: DataFrame, open_rest: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Narrow the ranks between which each source's rest is used up: from sums
    of words per bucket of ranks, (_key, _from, _width, _rest) one level deeper."""
    place = F.floor((F.col("_rank") - F.col("_from")) / F.col("_width") * buckets)
    inside = ranked.join(open_rest, "_key").withColumn("_bucket", F.least(F.greatest(place, F.lit(0)), F.lit(buckets - 1)))
    inside = inside.where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + F.col("_width")))
    sums = inside.groupBy("_key", "_from", "_width", "_rest", "_bucket").agg(F.sum("size").alias("_words"))
    up_to = F.sum("_words").over(Window.partitionBy("_key").orderBy("_bucket"))
    crossing = (
        sums.withColumn("_up_to", up_to)
        .where(F.col("_up_to") > F.col("_rest"))
        .groupBy("_key", "_from", "_width")
        .agg(F.min(F.struct("_bucket", (F.col("_rest") - F.col("_up_to") + F.col("_words")).alias("left"))).alias("at"))
    )
    step = F.col("_width") / buckets
    return inside, crossing.select(
        "_key", (F.col("_from") + F.col("at._bucket") * step).alias("_from"), step.alias("_width"), F.col("at.left").alias("_rest")
    )


def mix_sources(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 20,
    buckets: int = 4096,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: its size in words, its source's size and target,
    how often it is taken (`copies`) and the words that makes (`taken`).

    The rank at which a source is full is searched in two rounds of sums per
    bucket, then among the few documents of one bucket, so no task sorts a
    source. The gap that whole documents leave is closed by the one document
    left over whose size is nearest to it, if that helps.

    A null text has no words; null sources are one source, the last one. The
    draw depends on id and seed, so reruns agree; repeated rows are documents
    of their own. Sources without words have target 0. Very long documents are
    counted whole, other columns are ignored, no rows give no rows.
    """
    name = F.col(source).cast("string")
    sizes = stored(
        docs.select(
            F.col(key).cast("long").alias(key),
            F.when(name.isNull(), "b").otherwise(F.concat(F.lit("a"), name)).alias("_key"),
            F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    wanted = targets(source_sizes(sizes), weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = wanted.withColumn("_whole", F.floor(ratio).cast("long"))
    wanted = stored(wanted.withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")))
    scales = _inclusion(sizes, wanted.select("_key", "_rest"))
    ranked = stored(
        sizes.join(scales, "_key", "left").select(key, "_key", "size", "_row", _rank(key, seed).alias("_rank"))
    )
    level = wanted.select("_key", F.lit(0.0).alias("_from"), F.lit(1.0).alias("_width"), "_rest")
    inside = ranked
    for _ in range(2):
        inside, level = _cut(inside.select(*ranked.columns), level, buckets)
        level = stored(level)
    # The documents of the last bucket, one after the other.
    last = inside.select(*ranked.columns).join(level, "_key")
    last = last.where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + F.col("_width")))
    order = Window.partitionBy("_key").orderBy("_rank", key, "size", "_row")
    last = last.withColumn("_up_to", F.sum("size").over(order))
    fits = last.where(F.col("_up_to") <= F.col("_rest")).select("_row", F.lit(1).alias("_fits"))
    taken = stored(
        ranked.join(level.select("_key", "_from"), "_key", "left")
        .join(fits, "_row", "left")
        .join(wanted, "_key")
        .withColumn("_sampled", ((F.col("_rank") < F.coalesce("_from", F.lit(1.0))) | F.col("_fits").isNotNull()).cast("long"))
    )
    gaps = taken.groupBy("_key").agg((F.first("_rest") - F.sum(F.col("_sampled") * F.col("size"))).alias("_gap"))
    off = F.abs(F.col("size") - F.col("_gap"))
    closing = (
        taken.where("_sampled = 0 and _rest > 0")
        .join(gaps, "_key")
        .where(off < F.col("_gap"))
        .groupBy("_key")
        .agg(F.min(F.struct(off.alias("off"), "_rank", key, "_row")).alias("best"))
        .select(F.col("best._row").alias("_row"), F.lit(1).alias("_closing"))
    )
    copies = F.col("_whole") + F.col("_sampled") + F.coalesce("_closing", F.lit(0))
    return (
        taken.join(closing, "_row", "left")
        .withColumn("copies", copies.cast("long"))
        .select(key, "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
    )


def _rank(key: str, seed: int) -> Column:
    """Random odds over the odds of inclusion, from 0 up to and without 1:
    q / (1 + q) keeps their order. Certain documents have 0; impossible ones, 1."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 11)
    u = (bits + F.lit(0.5)) / F.lit(float(1 << 53))
    p = F.least(F.coalesce(F.col("_scale"), F.lit(0.0)) * F.sqrt("size"), F.lit(1.0))
    odds, chance = u * (1 - p), p * (1 - u)
    return F.when(p <= 0, F.lit(1.0)).otherwise(odds / (odds + chance))
