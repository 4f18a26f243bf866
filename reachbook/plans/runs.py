"""Message runs: spans of qualifying messages and the outcome of each run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachbook.campaign import Campaign
from reachbook.functions import classify
from reachbook.functions.calendar import day_after, day_before
from reachbook.operators import filters
from reachbook.operators.lookups import area_lookup, hash_first, numbered, numbered_by_counts, numbered_by_ranges, snapshot_lookup

READINGS = (
    "DPD_Min", "DPD_Max", "DPD_Max_1", "TotalOSPrincipal", "Installment Amount Latest", "DefaultStatus",
    "Provinsi", "Kab", "Kec", "Desa",
)


def _serving_snapshots(campaign: Campaign) -> DataFrame:
    """Normal-status snapshots under the message day they serve, the next one.

    This match uses the stored agreement number, leading blanks included.
    """
    return campaign.served_snapshots.where(filters.status_normal(stored=True)).select(
        F.col("AgreementNo").alias("_agreement"),
        day_after("ReportDate").alias("_day"),
        "angsuran",
        "DefaultStatus",
    )


def _serves_message():
    return (F.col("agreementno") == F.col("_agreement")) & (F.col("pt") == F.col("_day"))


def qualified_messages(campaign: Campaign) -> DataFrame:
    """Messages that start or extend a run, with instalment and loan status."""
    return (
        campaign.messages.where(
            filters.in_channels(campaign.run_channels, stored=True)
            & filters.in_products(campaign.products, stored=True)
            & filters.positive_dpd()
        )
        .join(_serving_snapshots(campaign), _serves_message())
        .select(
            "agreementno", "product", "assigned_dpd", "pt", "subcgid", "disposition", "angsuran", "DefaultStatus"
        )
    )


def _splits(campaign: Campaign, by_contact: bool) -> list[tuple[str, str | None]]:
    """The kinds of runs: one per product, and per contact group if asked."""
    groups = (classify.CONTACTED, classify.UNCONTACTED) if by_contact else (None,)
    return [(product, group) for product in campaign.products for group in groups]


def _message_days(campaign: Campaign, by_contact: bool) -> DataFrame:
    """One row per agreement and day, with a flag per kind of run its messages count for.

    That aggregate is laid out on the keys of the joins that follow, so they read
    it without another shuffle and a flood of messages to one agreement is gone
    before it.
    """
    channels = campaign.message_channels if by_contact else campaign.run_channels
    messages = campaign.messages.where(
        filters.in_channels(channels, stored=True)
        & filters.in_products(campaign.products, stored=True)
        & filters.positive_dpd()
    )
    flags = []
    for i, (product, group) in enumerate(_splits(campaign, by_contact)):
        member = F.col("product") == product
        if group:
            member = member & (classify.grouped_disposition() == group)
        flags.append(F.max(member).alias(f"_in{i}"))
    return messages.groupBy("agreementno", "pt").agg(*flags)


def run_spans(campaign: Campaign, by_contact: bool = False) -> DataFrame:
    """First and last message day per agreement, product and instalment, and by
    contact group if asked."""
    splits = _splits(campaign, by_contact)
    spans = []
    for i, _ in enumerate(splits):
        day = F.when(F.col(f"_in{i}"), F.col("pt"))
        spans += [F.min(day).alias(f"_first{i}"), F.max(day).alias(f"_last{i}")]
    instalments = (
        _message_days(campaign, by_contact)
        .join(_serving_snapshots(campaign), _serves_message())
        .groupBy("agreementno", "angsuran")
        .agg(*spans)
    )

    runs = []
    for i, (product, group) in enumerate(splits):
        fields = [F.lit(product).alias("product")]
        fields += [F.col(f"_first{i}").alias("min__pt"), F.col(f"_last{i}").alias("max__pt")]
        if group:
            fields.append(F.lit(group).alias("Grouped_Disposition"))
        runs.append(F.struct(*fields))
    kept = ["agreementno", "run.product", "angsuran", "run.min__pt", "run.max__pt"]
    if by_contact:
        kept.append("run.Grouped_Disposition")
    return (
        instalments.select("agreementno", "angsuran", F.explode(F.array(*runs)).alias("run"))
        .where(F.col("run.min__pt").isNotNull())
        .select(*kept)
    )


# What the loan book says of an agreement around a message day: the day before,
# the day itself, the day after, and the columns each is asked for.
_BEFORE, _ON, _AFTER = -1, 0, 1
_ASKED = {
    _BEFORE: ("DaysOverDueTolerance", "TotalOSPrincipal", "Installment Amount Latest", "DefaultStatus"),
    _ON: ("DaysOverDueTolerance",),
    _AFTER: ("DaysOverDueTolerance", "TotalOSPrincipal", "Installment Amount Latest", "AgreementNo", "ReportDate"),
}
# Rows that equal ones turn into at once.
BLOCK = 10_000


def _read_days(campaign: Campaign, by_contact: bool, sides: tuple[int, ...]) -> DataFrame:
    """Message days with the loan book around them, in one join.

    A message day asks for up to three days of its agreement. Snapshots that say
    the same become one entry with a number of copies, before they are shuffled,
    so loading a snapshot many times costs one entry. A day then holds one short
    list of entries, and the instalments whose runs it starts or extends.
    """
    text = {f.name for f in campaign.snapshots.schema if isinstance(f.dataType, T.StringType)}
    names = list(dict.fromkeys(c for side in sides for c in _ASKED[side]))
    book = campaign.served_snapshots.select(
        F.col("agreement_key").alias("_key"),
        F.col("AgreementNo").alias("_stored"),
        F.col("ReportDate").alias("_reported"),
        "angsuran",
        filters.status_normal().alias("_normal"),
        *[(F.col(f"`{c}`").cast("string") if c in text else F.col(f"`{c}`")).alias(f"_{c}") for c in names],
    )
    days = _message_days(campaign, by_contact)
    flags = [c for c in days.columns if c.startswith("_in")]
    wanted = days.select(
        "*", F.trim("agreementno").alias("agreement_key"), F.explode(F.array(*[F.lit(s) for s in sides])).alias("_side")
    )
    wanted = wanted.withColumn("_day", F.date_add("pt", F.col("_side")))
    met = wanted.join(book, (F.col("agreement_key") == F.col("_key")) & (F.col("_day") == F.col("_reported")))
    # Runs match the stored agreement number, leading blanks included.
    serves = (F.col("_side") == _BEFORE) & F.col("_normal") & (F.col("_stored") == F.col("agreementno"))
    # A side's other readings are left out, so they tell no entries apart.
    asking = {c: [side for side in sides if c in _ASKED[side]] for c in names}
    entries = met.select(
        "agreementno",
        "pt",
        *flags,
        "_side",
        F.when(serves, F.struct("angsuran")).alias("_serves"),
        *[F.when(F.col("_side").isin(own), F.col(f"`_{c}`")).alias(f"_{c}") for c, own in asking.items()],
    )
    entries = entries.groupBy(*[f"`{c}`" for c in entries.columns]).agg(F.count("*").alias("_copies"))
    entry = F.struct("_side", *[F.col(f"`_{c}`").alias(c) for c in names], "_copies")
    lists = F.collect_set("_serves").alias("_serves"), F.collect_list(entry).alias("_read")
    return entries.groupBy("agreementno", "pt", *flags).agg(*lists)


def _read_runs(campaign: Campaign, by_contact: bool, sides: tuple[int, ...]) -> DataFrame:
    """Runs with what the loan book says around their first and last message day.
    The lists come with the days that the spans pick, so nothing is joined again."""
    days = _read_days(campaign, by_contact, sides).withColumn("_served", F.explode("_serves"))
    splits = _splits(campaign, by_contact)
    spans = []
    for i, _ in enumerate(splits):
        inside = F.col(f"_in{i}")
        spans.append(F.min(F.when(inside, F.struct("pt", "_read"))).alias(f"_first{i}"))
        spans.append(F.max(F.when(inside, F.struct("pt", "_read"))).alias(f"_last{i}"))
    instalments = days.groupBy("agreementno", F.col("_served.angsuran").alias("angsuran")).agg(*spans)
    runs = []
    for i, (product, group) in enumerate(splits):
        first, last = F.col(f"_first{i}"), F.col(f"_last{i}")
        fields = [F.lit(product).alias("product"), first["pt"].alias("min__pt"), last["pt"].alias("max__pt")]
        if group:
            fields.append(F.lit(group).alias("Grouped_Disposition"))
        runs.append(F.struct(*fields, first["_read"].alias("first"), last["_read"].alias("last")))

    def side(name: str, kept: int):
        return F.filter(f"run.{name}", lambda x: x["_side"] == kept)

    shown = ["agreementno", "run.product", "angsuran", "run.min__pt", "run.max__pt"]
    shown += ["run.Grouped_Disposition"] * by_contact
    shown += [side("first", _BEFORE).alias("_p"), side("last", _BEFORE).alias("_r"), side("last", _ON).alias("_w")]
    shown += [side("last", _AFTER).alias("_n")] * (_AFTER in sides)
    return (
        instalments.select("agreementno", "angsuran", F.explode(F.array(*runs)).alias("run"))
        .where(F.col("run.min__pt").isNotNull())
        .select(*shown)
    )


def _one_by_one(df: DataFrame, lists: dict[str, str]) -> DataFrame:
    """A row per entry of each list (name: name of the entry), and one with no
    entry where a list is empty; entries with copies give as many rows."""
    for name, entry in lists.items():
        df = df.withColumn(entry, F.explode_outer(name))
    copies = " * ".join(f"coalesce({entry}._copies, 1)" for entry in lists.values())
    # In blocks, so no row holds a number per copy of a huge group.
    blocks = df.withColumn("_copies", F.expr(copies)).withColumn("_block", F.explode(F.expr(f"sequence(0, (_copies - 1) div {BLOCK})")))
    left = f"least(_copies - _block * {BLOCK}, {BLOCK})"
    return blocks.withColumn("_copy", F.explode(F.expr(f"sequence(1, {left})"))).drop(*lists, "_copies", "_block", "_copy")


def with_key(runs: DataFrame) -> DataFrame:
    return runs.withColumn("agreement_key", F.trim("agreementno"))


def before_first(campaign: Campaign, runs: DataFrame) -> DataFrame:
    columns = {
        "DPD_Min": "DaysOverDueTolerance",
        "TotalOSPrincipal": "TotalOSPrincipal",
        "Installment Amount Latest": "Installment Amount Latest",
        "DefaultStatus": "DefaultStatus",
    }
    return snapshot_lookup(runs, campaign.served_snapshots, day_before("min__pt"), columns)


def before_last(campaign: Campaign, runs: DataFrame) -> DataFrame:
    return snapshot_lookup(runs, campaign.served_snapshots, day_before("max__pt"), {"DPD_Max": "DaysOverDueTolerance"})


def on_last(campaign: Campaign, runs: DataFrame) -> DataFrame:
    return snapshot_lookup(runs, campaign.served_snapshots, F.col("max__pt"), {"DPD_Max_1": "DaysOverDueTolerance"})


def judged(campaign: Campaign, by_contact: bool = False, *, next_day: bool = False) -> DataFrame:
    """Runs with their loan-book readings, area, success flag and sequence; with
    `_n`, the readings of the day after, if asked.

    The loan book is read and joined once, whatever the number of lookups.
    """
    flagged = _unnumbered(campaign, by_contact, next_day)
    return numbered(flagged, *_SEQUENCE, skip=["max__pt", "_n"])


# Runs that share a list of the next day are one run: `_n` orders nothing.
_SEQUENCE = (["agreement_key", "agreementno"], ["max__pt asc nulls first"], "rownum")


def _unnumbered(campaign: Campaign, by_contact: bool, next_day: bool) -> DataFrame:
    runs = _read_runs(campaign, by_contact, (_BEFORE, _ON, _AFTER) if next_day else (_BEFORE, _ON))
    read = _one_by_one(runs, {"_p": "p", "_r": "r", "_w": "w"})
    readings = {
        "DPD_Min": "p.DaysOverDueTolerance",
        "DPD_Max": "r.DaysOverDueTolerance",
        "DPD_Max_1": "w.DaysOverDueTolerance",
        "TotalOSPrincipal": "p.TotalOSPrincipal",
        "Installment Amount Latest": "p.`Installment Amount Latest`",
        "DefaultStatus": "p.DefaultStatus",
    }
    shown = [c for c in runs.columns if c not in ("_p", "_r", "_w")]
    looked_up = read.select(
        F.trim("agreementno").alias("agreement_key"), *shown, *[_as_in_book(campaign, v, k) for k, v in readings.items()]
    )
    placed = area_lookup(looked_up, campaign.served_areas)
    keys = ["agreement_key", *[c for c in shown if c != "_n"]]
    return placed.select(
        *keys, *[f"`{c}`" for c in READINGS], classify.run_success("DPD_Max_1").alias("SR"), *["_n"] * next_day
    )


def _as_in_book(campaign: Campaign, value: str, name: str):
    """A reading under its name, text with the collation it has in the loan book."""
    column = F.col(value)
    field = value.split(".")[-1]
    kind = campaign.snapshots.schema[field].dataType if field in campaign.snapshots.columns else None
    return (column.cast(kind) if isinstance(kind, T.StringType) and kind != T.StringType() else column).alias(name)


def run_outcome(campaign: Campaign) -> DataFrame:
    """One row per run (more where snapshots are doubled): readings, area, SR."""
    return judged(campaign).drop("agreement_key")


def run_sequence(campaign: Campaign, by_contact: bool = False) -> DataFrame:
    """The same rows and numbers, for reading all of them: an agreement with any
    number of runs and doubled snapshots is numbered in ranges. In `run_outcome`
    the number is a plain window, which a query that leaves it out does not pay."""
    flagged = _unnumbered(campaign, by_contact, next_day=False)
    return numbered_by_ranges(flagged, *_SEQUENCE, skip=["max__pt"]).drop("agreement_key")


def next_day_snapshot(campaign: Campaign) -> DataFrame:
    """Run outcomes with the loan book of the day after the last message."""
    return _next_day(campaign).drop("agreement_key")


def _next_day(campaign: Campaign) -> DataFrame:
    columns = {
        "nomor_kontrak": "n.AgreementNo",
        "osp": "n.TotalOSPrincipal",
        "DPD_Max_2": "n.DaysOverDueTolerance",
        "installment_amount": "n.`Installment Amount Latest`",
        "ReportDate": "n.ReportDate",
    }
    runs = judged(campaign, next_day=True)
    shown = [f"`{c}`" for c in runs.columns if c != "_n"]
    looked_up = _one_by_one(runs, {"_n": "n"}).select(
        *shown, *[_as_in_book(campaign, value, name) for name, value in columns.items()]
    )
    # A missing instalment number leaves just the agreement number.
    label = F.concat_ws("", "agreementno", F.col("angsuran").cast("string"))
    return looked_up.withColumns({"Dummy": label, "max__pt_1": day_after("max__pt")})


def first_contacts(campaign: Campaign) -> DataFrame:
    """One contact per agreement and day over every agent type, unknown first.

    Only the agent type is kept beside the keys, so the first row is a minimum
    and each input partition sends one row per agreement and day.
    """
    messages = campaign.messages.select("agreementno", "agent_type", "pt")
    untyped = F.max(F.col("agent_type").isNull())
    # A minimum of text is found by sorting.
    keys = [F.expr(key) for key in hash_first(messages, ["agreementno", "pt"])]
    return (
        messages.groupBy(*keys)
        .agg(F.when(~untyped, F.min("agent_type")).alias("agent_type"))
        .select("agreementno", "agent_type", "pt")
    )


def contacted_days(campaign: Campaign) -> DataFrame:
    """Agreement and days whose first contact has an agent type, whichever."""
    typed = F.min(F.col("agent_type").isNotNull()).alias("typed")
    days = campaign.messages.groupBy("agreementno", "pt").agg(typed).where("typed")
    return days.selectExpr("agreementno", "'typed' as agent_type", "pt")


def numbered_contacts(campaign: Campaign) -> DataFrame:
    """Every contact numbered per agreement and day, unknown agent type first."""
    contacts = campaign.messages.select("agreementno", "agent_type", "pt")
    return numbered_by_counts(contacts, ["agreementno", "pt"], "agent_type", "row_number")


def with_contact(runs: DataFrame, contacts: DataFrame) -> DataFrame:
    """Attach the contact of the day after the last message, if any."""
    right = contacts.selectExpr("trim(agreementno) as _key", "agreementno as no_kontrak", "agent_type", "pt")
    matches = (F.col("agreement_key") == F.col("_key")) & (F.col("max__pt_1") == F.col("pt"))
    return runs.join(right, matches, "left").drop("_key")


def next_day_contact(campaign: Campaign) -> DataFrame:
    """Next-day outcomes with the contact made on that next day, if any."""
    return with_contact(_next_day(campaign), first_contacts(campaign)).drop("agreement_key")
