"""Schemas of the input tables and the cleanup done once at the edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

ACTIVITY = T.StructType(
    [
        T.StructField("agreementno", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("assigned_dpd", T.StringType()),
        T.StructField("assigned_date", T.DateType()),
        T.StructField("activity_date", T.TimestampNTZType()),
        T.StructField("agent_id", T.StringType()),
        T.StructField("agent_type", T.StringType()),
        T.StructField("disposition", T.StringType()),
        T.StructField("contact_number", T.StringType()),
        T.StructField("persona_name", T.StringType()),
        T.StructField("contact_type", T.StringType()),
        T.StructField("subcgid", T.IntegerType()),
        T.StructField("pt", T.DateType()),
    ]
)

LOANS = T.StructType(
    [
        T.StructField("AgreementNo", T.StringType()),
        T.StructField("ReportDate", T.DateType()),
        T.StructField("angsuran", T.IntegerType()),
        T.StructField("DefaultStatus", T.StringType()),
        T.StructField("DaysOverDueTolerance", T.IntegerType()),
        T.StructField("TotalOSPrincipal", MONEY),
        T.StructField("Installment Amount Latest", MONEY),
        T.StructField("Product", T.StringType()),
    ]
)

AREAS = T.StructType(
    [
        T.StructField("AgreementNo", T.StringType()),
        T.StructField("Provinsi", T.StringType()),
        T.StructField("Kab", T.StringType()),
        T.StructField("Kec", T.StringType()),
        T.StructField("Desa", T.StringType()),
        T.StructField("SubCGID", T.IntegerType()),
        T.StructField("SK_Time", T.StringType()),
    ]
)

# Text that is matched, grouped or compared with a constant. Trailing blanks
# carry no meaning there, so they are cut once when a table is read.
COMPARED = {
    "agreementno", "product", "assigned_dpd", "agent_type", "disposition", "contact_number",
    "defaultstatus", "provinsi", "kab", "kec", "desa", "sk_time",
}

# Of these, the ones that lists and constants are compared with are also kept as
# stored, under a name of their own: tests on them reach the files.
STORED = {"agent_type", "product", "defaultstatus"}

# Days that a deployment may store with a time of day; the date filters need it.
MOMENTS = {"pt", "reportdate"}


def as_stored(name: str) -> str:
    return f"_stored_{name.lower()}"


def conform(df: DataFrame, schema: T.StructType, collation: str | None = None) -> DataFrame:
    """Select the declared columns with their declared types and clean text.

    Adds `agreement_key`, the agreement number without blanks on either side:
    most matches use it, a few need the stored number with its leading blanks.
    A table stored with that column keeps it, and with it its buckets.
    An optional collation such as UTF8_LCASE makes text matches ignore case; the
    text as stored is then not compared and NULL.
    """
    stored = {field.name.lower(): field.dataType for field in df.schema}
    columns = []
    for field in schema:
        name, column = field.name.lower(), f"`{field.name}`"
        keeps_time = name in MOMENTS and isinstance(stored[name], (T.TimestampType, T.TimestampNTZType))
        if stored[name] != field.dataType and not keeps_time:
            column = f"cast({column} as {field.dataType.simpleString()})"
        if name in COMPARED:
            column = f"rtrim({column})"
            if collation:
                column = f"collate({column}, '{collation}')"
        columns.append(f"{column} as `{field.name}`")
        if name in STORED:
            plain = not collation and stored[name] == T.StringType()
            columns.append(f"{f'`{field.name}`' if plain else 'cast(null as string)'} as `{as_stored(name)}`")
    if "agreement_key" in stored and not collation:
        return df.selectExpr(*columns, "agreement_key")
    return df.selectExpr(*columns).selectExpr("*", "trim(agreementno) as agreement_key")
