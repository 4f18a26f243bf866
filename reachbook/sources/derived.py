"""The three input tables derived from the driver's parquet tables.

Activity is one row per event; the loan book has one row per user and day with
some days missing and some doubled; areas come from the customer geography.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that no job is spent on reading file footers for a schema.
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
NATION = "n_nationkey int, n_name string, n_regionkey int"
REGION = "r_regionkey int, r_name string"

# Dispositions by event type, picked by event number.
WHATSAPP_DISPOSITIONS = ("REPLIED", "READ", "DELIVERED", "SENT", "SCHEDULED", "TRIGGERED", "FAILED")
IVR_DISPOSITIONS = ("ANSWERED", "NOT_ANSWERED", "FAILED")
SMS_DISPOSITIONS = (
    "DELIVERED", "SENT", "REJECTED", "UNDELIV", "EXPIRED", "UNKNOWN",
    "BUFFERED", "UNDELIVRD", "REJECTD", "UNDELIVERD", "FAILED",
)
AREA_SNAPSHOTS = ("20240131", "20231231")


def _read(spark: SparkSession, sf_dir: str, table: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/{table}.parquet")


def _agreement(user: str) -> str:
    return f"concat('AG', lpad(cast({user} as string), 8, '0'))"


def _pick(values: tuple[str, ...], unlisted: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    position = f"cast(event_id % {len(values)} + 1 as int)"
    return f"if(event_id % 41 = 0, '{unlisted}', element_at(array({listed}), {position}))"


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events", EVENTS).selectExpr(
        f"concat(if(user_id % 50 = 49, ' ', ''), {_agreement('user_id')}, if(event_id % 11 = 0, '  ', ''))"
        " as agreementno",
        "case when user_id % 10 = 0 then 'HOME' when user_id % 2 = 1 then 'MCY' else 'CAR' end as product",
        "case event_id % 9 when 0 then '0' when 1 then '-3' else cast(event_id % 9 as string) end as assigned_dpd",
        "cast(ts as date) as assigned_date",
        "ts as activity_date",
        "concat('A', event_id % 17) as agent_id",
        "case event_type when 'click' then 'WHATSAPP' when 'view' then 'IVR' when 'signup' then 'SMS'"
        " when 'purchase' then 'DIGITAL' when 'error' then if(event_id % 13 = 0, null, 'FIELD') end as agent_type",
        f"case event_type when 'click' then {_pick(WHATSAPP_DISPOSITIONS, 'BOUNCED')}"
        f" when 'view' then {_pick(IVR_DISPOSITIONS, 'BUSY')}"
        f" when 'signup' then {_pick(SMS_DISPOSITIONS, 'QUEUED')} else 'OTHER' end as disposition",
        "case when event_id % 5 = 0 then '62' when event_id % 23 = 0 then null"
        " else concat('62', user_id + 800000) end as contact_number",
        "concat('P', event_id % 3) as persona_name",
        "if(event_id % 2 = 0, 'SELF', 'FAMILY') as contact_type",
        "cast(user_id % 6 as int) as subcgid",
        "cast(ts as date) as pt",
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user on every event day. The days are one array, at most one entry
    per calendar day, read as a scalar subquery and exploded per user."""
    events = _read(spark, sf_dir, "events", EVENTS)
    days = events.selectExpr("collect_set(cast(ts as date))").scalar()
    user_days = (
        events.selectExpr("user_id as u")
        .distinct()
        .select("u", F.explode(days).alias("day"))
        .selectExpr("u", "date_sub(day, 1) as rd", "datediff(day, date'2024-01-01') as n")
        .where("(u * 7 + n * 3) % 11 <> 0")
    )
    overdue = "cast(if((u + n) % 5 = 0, 0, (u * 3 + n) % 90) as int)"
    doubled = "u % 37 = 5 and day(rd) % 10 = 4"
    return user_days.selectExpr(
        f"{_agreement('u')} as AgreementNo",
        "rd as ReportDate",
        "cast(1 + u % 24 + if(n >= 15, 1, 0) as int) as angsuran",
        "case when u % 8 = 7 then 'WO' when u % 16 = 9 then 'RS' when u % 16 <> 3 then 'NM' end as DefaultStatus",
        f"explode(if({doubled}, array({overdue}, {overdue} + 1), array({overdue}))) as DaysOverDueTolerance",
        "cast(1000000 + u * 1250.5 as decimal(18,2)) as TotalOSPrincipal",
        "cast(250000 + u * 10.25 as decimal(18,2)) as `Installment Amount Latest`",
        "if(u % 2 = 1, 'MCY', 'CAR') as Product",
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with events, placed by their nation."""
    contacted = _read(spark, sf_dir, "events", EVENTS).selectExpr("user_id as u").distinct()
    snapshots = ", ".join(f"'{s}'" for s in AREA_SNAPSHOTS)
    return (
        _read(spark, sf_dir, "customer", CUSTOMER)
        .where("c_custkey % 12 <> 5")
        .join(contacted, F.col("c_custkey") == F.col("u"), "left_semi")
        .join(_read(spark, sf_dir, "nation", NATION), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_read(spark, sf_dir, "region", REGION), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            f"{_agreement('c_custkey')} as AgreementNo",
            "r_name as Provinsi",
            "n_name as Kab",
            "c_mktsegment as Kec",
            "concat('Desa ', c_custkey % 20) as Desa",
            "cast(c_custkey % 6 as int) as SubCGID",
            f"explode(array({snapshots})) as SK_Time",
        )
    )
