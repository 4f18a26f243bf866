"""Best message per channel, and the channel report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachbook.campaign import Campaign
from reachbook.functions import classify
from reachbook.functions.calendar import day_after
from reachbook.operators import filters
from reachbook.operators.lookups import AREA_ORDER, best_area, numbered, numbered_by_ranges
from reachbook.plans import funnel
from reachbook.plans.outcomes import first_outcomes

# Names of the rank and number columns of the single-channel datasets.
CHANNEL_COLUMNS = {
    classify.WHATSAPP: ("dispositionwa", "rn_wa"),
    classify.IVR: ("dispositionivr", "rn_ivr"),
    classify.SMS: ("dispositionsms", "rn_sms"),
}
# The three channels together carry the names of the first one.
RANK, NUMBER = CHANNEL_COLUMNS[classify.WHATSAPP]
# Ties on the rank letter are settled by the report's columns, then the others.
_REPORT_FIRST = ("product", *AREA_ORDER, "newSR")
_GROUP = ["agreementno", "angsuran"]
# Message columns that every candidate of a daily pick shares or is sorted by first.
_MESSAGE_KEYS = ("agreementno", "agent_type", "product", "pt")
_MEDIA = (*funnel.MESSAGE, *AREA_ORDER, "angsuran", *funnel.OUTCOME, "Disposition_NEW", "disposition2")


def media(campaign: Campaign) -> DataFrame:
    """The funnel with the report form of the disposition."""
    return funnel.funnel_outcome(campaign).withColumn("disposition2", classify.report_outcome())


def _by_rank(campaign: Campaign, rank: str = RANK) -> str:
    return f"{rank} asc nulls {'first' if campaign.unmapped_first else 'last'}"


def channel_media(campaign: Campaign, channel: str) -> DataFrame:
    """Messages of one channel with their rank letter."""
    rank, _ = CHANNEL_COLUMNS[channel]
    return media(campaign).where(F.col("agent_type") == channel).withColumn(rank, classify.rank_letter())


def ranked_media(campaign: Campaign, channel: str) -> DataFrame:
    """Messages of one channel numbered per agreement and instalment, as a plain
    window: a filter on the number shrinks it to the picks."""
    rank, number = CHANNEL_COLUMNS[channel]
    return numbered(
        channel_media(campaign, channel), _GROUP, _ranking(campaign, rank), number, skip=[rank, *_REPORT_FIRST]
    )


def full_ranking(campaign: Campaign, channel: str) -> DataFrame:
    """The same rows and numbers, for reading all of them: a busy agreement is
    numbered in ranges, a flood within one minute too."""
    rank, number = CHANNEL_COLUMNS[channel]
    return numbered_by_ranges(
        channel_media(campaign, channel), _GROUP, _ranking(campaign, rank), number, skip=[rank, *_REPORT_FIRST]
    )


def _ranking(campaign: Campaign, rank: str) -> list[str]:
    return [_by_rank(campaign, rank), *[f"{c} asc nulls first" for c in _REPORT_FIRST]]


def best_media(campaign: Campaign, channels: Sequence[str] | None = None) -> DataFrame:
    """The best message per channel, agreement and instalment, with its area and
    run outcome.

    A message's instalment, area and outcome depend on agreement and day only,
    never on the message. So messages shrink to the best one per day, then to
    the best one per instalment, and only then meet one area and one outcome.
    No join here sees the messages of a busy agreement.

    The best message is the least struct in tie-break order, one per channel
    side by side, so the daily rows leave their aggregate on the join's keys.
    """
    channels = {f"_best{i}": channel for i, channel in enumerate(channels or campaign.message_channels)}
    order = [RANK, "product", *[c for c in funnel.MESSAGE if c not in _MESSAGE_KEYS]]
    # A struct with a NULL sorts before one with a value.
    unlisted = [] if campaign.unmapped_first else [F.col(RANK).isNull().alias("unlisted")]
    message = F.struct(*unlisted, *order)
    messages = funnel.funnel_messages(campaign).withColumn(RANK, classify.rank_letter())
    daily = (
        messages.where(filters.in_channels(list(channels.values())))
        .groupBy("agreement_key", "pt")
        .agg(*[F.min(F.when(F.col("agent_type") == c, message)).alias(best) for best, c in channels.items()])
    )
    served = daily.join(funnel.serving_loans(campaign), ["agreement_key", "pt"])
    instalments = served.groupBy("agreement_key", "angsuran").agg(
        *[F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("message"), "pt"))).alias(c) for c in channels]
    )
    placed = funnel.with_outcome(instalments, first_outcomes(campaign, list(funnel.OUTCOME))).join(
        best_area(campaign.served_areas), "agreement_key", "left"
    )
    each = F.array(*[F.struct(F.lit(c).alias("agent_type"), F.col(best).alias("best")) for best, c in channels.items()])
    return (
        placed.select("*", F.explode(each).alias("of"))
        .where("of.best is not null")
        .select(
            F.col("agreement_key").alias("agreementno"),
            "angsuran",
            *AREA_ORDER,
            *funnel.OUTCOME,
            "of.agent_type",
            "of.best.pt",
            *[f"of.best.message.{c}" for c in order],
        )
        .withColumns(
            {
                "product": classify.as_listed("product", campaign.products),
                "Disposition_NEW": classify.funnel_outcome(),
                "disposition2": classify.report_outcome(),
                NUMBER: F.lit(1),
            }
        )
        .select(*_MEDIA, RANK, NUMBER)
    )


def best_of_channel(campaign: Campaign, channel: str) -> DataFrame:
    """The best messages of one channel, under that channel's column names."""
    rank, number = CHANNEL_COLUMNS[channel]
    return best_media(campaign, [channel]).withColumnsRenamed({RANK: rank, NUMBER: number})


def summarise(best: DataFrame) -> DataFrame:
    """Count best messages and add up successes per report line.

    The column `agreementno` of the report is a count.
    """
    keys = ["product", "angsuran", F.col("disposition2").alias("disposition"), "agent_type", *AREA_ORDER]
    return best.groupBy(*keys).agg(F.count("agreementno").alias("agreementno"), F.sum("newSR").alias("newSR"))


def channel_report(campaign: Campaign) -> DataFrame:
    """The channel report, summarise(best_media(...)), in one pass per table.

    Messages and snapshots are each reduced to one small row per agreement and
    day, then laid on one timeline per agreement. Every exact-day lookup (the
    day before a message, its own day, the day after) is a range frame of one
    day on that timeline, so loan book and activity are read once and never
    joined, and the timeline's layout carries through to the report's groups.
    """
    return report_of_days(
        campaign, loan_partials(campaign, campaign.served_snapshots), message_partials(campaign, campaign.messages)
    )


def report_of_days(campaign: Campaign, loans: DataFrame, messages: DataFrame) -> DataFrame:
    """The report from what is known of each agreement and day."""
    key = F.trim("agreementno")
    loan_rows = loans.select(
        key.alias("agreement_key"),
        "day",
        "angsuran",
        F.lit(True).alias("loan"),
        (F.col("normal") & (F.col("agreementno") == key)).alias("normal"),
        "live",
        "overdue",
    )
    # Outcomes are matched on the clean number, so only runs stored under it count.
    message_rows = messages.select(
        key.alias("agreement_key"),
        "day",
        "contacted",
        *[(F.col(run) & (F.col("agreementno") == key)).alias(run) for run in _runs(campaign)],
        *_bests(campaign),
    )
    timeline = loan_rows.unionByName(message_rows, allowMissingColumns=True)
    return _report_lines(campaign, _instalment_days(campaign, timeline))


def loan_partials(campaign: Campaign, snapshots: DataFrame) -> DataFrame:
    """Per agreement, day and instalment: what any of its snapshots says."""
    known = snapshots.where(F.col("AgreementNo").isNotNull())
    return known.groupBy(F.col("AgreementNo").alias("agreementno"), F.col("ReportDate").alias("day"), "angsuran").agg(
        F.max(filters.status_normal()).alias("normal"),
        F.max(filters.not_written_off()).alias("live"),
        F.max(F.col("DaysOverDueTolerance") != 0).alias("overdue"),
    )


def merged_loans(campaign: Campaign, partials: DataFrame) -> DataFrame:
    """The same of rows that were found apart."""
    flags = [F.max(name).alias(name) for name in ("normal", "live", "overdue")]
    return partials.groupBy("agreementno", "day", "angsuran").agg(*flags)


def message_partials(campaign: Campaign, messages: DataFrame) -> DataFrame:
    """Per stored agreement number and day: a flag per product that qualifies
    for a run, the best score per channel, and whether the contact is typed."""
    product = F.col("product")
    position = F.coalesce(*[F.when(product == p, i) for i, p in _positions(campaign)])
    score = F.coalesce(classify.outcome_rank(), F.lit(_unmapped_rank(campaign))) * len(campaign.products) + position
    qualifies = filters.in_channels(campaign.run_channels) & filters.positive_dpd()
    runs = [F.max(qualifies & (product == p)).alias(run) for run, p in _runs(campaign).items()]
    # Unlisted products have no position, hence no score.
    scores = [F.min(F.when(F.col("agent_type") == c, score)).alias(best) for best, c in _bests(campaign).items()]
    known = messages.where(F.col("agreementno").isNotNull())
    return known.groupBy("agreementno", F.col("pt").alias("day")).agg(
        F.min(F.col("agent_type").isNotNull()).alias("contacted"), *runs, *scores
    )


def merged_messages(campaign: Campaign, partials: DataFrame) -> DataFrame:
    """The same of rows that were found apart."""
    flags = [F.max(run).alias(run) for run in _runs(campaign)] + [F.min(best).alias(best) for best in _bests(campaign)]
    return partials.groupBy("agreementno", "day").agg(F.min("contacted").alias("contacted"), *flags)


def _runs(campaign: Campaign) -> dict[str, str]:
    """Flag columns of the products: names of ours, whatever the products are called."""
    return {f"_run{i}": product for i, product in enumerate(campaign.products)}


def _bests(campaign: Campaign) -> dict[str, str]:
    """Score columns of the channels."""
    return {f"_best{i}": channel for i, channel in enumerate(campaign.message_channels)}


def _positions(campaign: Campaign) -> list[tuple[int, str]]:
    """Products in tie-break order."""
    return list(enumerate(sorted(campaign.products)))


def _unmapped_rank(campaign: Campaign) -> int:
    return 0 if campaign.unmapped_first else 1 + max(len(d) for d in classify.OUTCOMES.values())


def _instalment_days(campaign: Campaign, timeline: DataFrame) -> DataFrame:
    """Each snapshot with the messages it serves and what followed them.

    A snapshot serves the messages of the next day. Those succeed unless the
    loan is overdue that next day; the day after gives one more chance.
    """
    by_day = Window.partitionBy("agreement_key").orderBy(F.unix_date("day"))
    next_day, second_day = by_day.rangeBetween(1, 1), by_day.rangeBetween(2, 2)
    served = [F.max(run).over(next_day).alias(run) for run in _runs(campaign)]
    served += [F.min(best).over(next_day).alias(best) for best in _bests(campaign)]
    return timeline.select(
        "agreement_key",
        "angsuran",
        "loan",
        "normal",
        "live",
        day_after("day").alias("day"),
        F.max("overdue").over(next_day).alias("overdue"),
        F.max("overdue").over(second_day).alias("overdue_after"),
        F.max("contacted").over(second_day).alias("contacted_after"),
        *served,
    ).where("loan")


def _report_lines(campaign: Campaign, instalments: DataFrame) -> DataFrame:
    # Success a run would have if this were its last message day.
    missed = F.lit(campaign.as_of.today) == day_after("day")
    missed = missed | F.coalesce("contacted_after", F.lit(False)) | F.coalesce("overdue_after", F.lit(False))
    success = F.when(F.col("overdue") & missed, 0).otherwise(1)
    per_product = [
        F.max_by(success, F.when(F.col("normal") & F.col(run), F.col("day"))) for run in _runs(campaign)
    ]
    worst = F.least(*per_product) if len(per_product) > 1 else per_product[0]
    known = F.col("angsuran").isNotNull()
    bests = [F.min(F.when(F.col("live"), F.col(best))).alias(best) for best in _bests(campaign)]
    per_instalment = instalments.groupBy("agreement_key", "angsuran").agg(
        F.when(known, worst).alias("newSR"), *bests
    )

    n = len(campaign.products)
    names = F.array(*[F.lit(p) for _, p in _positions(campaign)])
    channels = [
        F.struct(F.lit(c).alias("agent_type"), F.col(best).alias("score")) for best, c in _bests(campaign).items()
    ]
    best = (
        per_instalment.select("agreement_key", "angsuran", "newSR", F.explode(F.array(*channels)).alias("best"))
        .where(F.col("best.score").isNotNull())
        .select("agreement_key", "angsuran", "newSR", "best.*")
        .withColumn("product", F.element_at(names, F.col("score") % n + 1))
        .withColumn("disposition2", classify.report_outcome_of_rank("agent_type", f"score div {n}"))
        .withColumnRenamed("agreement_key", "agreementno")
    )
    areas = best_area(campaign.served_areas).withColumnRenamed("agreement_key", "agreementno")
    return summarise(best.join(areas, "agreementno", "left"))
