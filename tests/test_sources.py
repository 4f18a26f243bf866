"""Reading: text cleanup, key forms, other stored types, catalog names."""

from dataclasses import replace
from datetime import date, datetime

import pytest

from reachbook import AsOf, Campaign
from reachbook.plans import outcomes, report, runs
from reachbook.sources import tables
from tests.helpers import area, message, snapshot, spark_rows, write_tables

AS_OF = AsOf.at("2024-03-20 12:00:00")


def build(spark, folder, activity, loans, areas=(), **options):
    return Campaign.from_parquet(spark, AS_OF, **write_tables(folder, activity, loans, list(areas)), **options)


def test_trailing_blanks_never_matter(spark, tmp_path):
    plain = build(spark, tmp_path, [message()], [snapshot()], [area()])
    padded_folder = tmp_path / "padded"
    padded_folder.mkdir()
    padded = build(
        spark,
        padded_folder,
        [message(agreementno="A1  ", product="CAR ", agent_type="WHATSAPP ", disposition="READ  ")],
        [snapshot(AgreementNo="A1 ", DefaultStatus="NM ")],
        [area(AgreementNo="A1   ", SK_Time="20240331 ", Provinsi="P ")],
    )
    for plan in (runs.run_outcome, report.best_media, report.channel_report):
        assert spark_rows(plan(plain)) == spark_rows(plan(padded))
        assert plan(plain).count() == 1


def test_leading_blanks_matter_for_runs_only(spark, tmp_path):
    """The run match uses the stored number, the funnel match the clean one."""
    campaign = build(spark, tmp_path, [message(agreementno=" A1")], [snapshot()], [area()])
    assert runs.run_outcome(campaign).count() == 0
    best = report.best_media(campaign).collect()
    assert [(r.agreementno, r.newSR, r.Provinsi) for r in best] == [("A1", None, "P")]


def test_an_agreement_under_two_products_multiplies_rows(spark, tmp_path):
    activity = [message(), message(product="MCY", pt=date(2024, 3, 12))]
    loans = [snapshot(), snapshot(ReportDate=date(2024, 3, 11))]
    campaign = build(spark, tmp_path, activity, loans)
    assert outcomes.unique_installments(campaign).count() == 2
    assert report.media(campaign).count() == 4
    assert report.channel_report(campaign).selectExpr("sum(agreementno)").first()[0] == 1


def test_case_folding_is_a_choice(spark, tmp_path):
    odd = message(agreementno="a1", product="car", agent_type="WhatsApp", disposition="Read")
    rows = [odd], [snapshot()], [area()]
    assert report.channel_report(build(spark, tmp_path, *rows)).count() == 0
    folded_folder = tmp_path / "folded"
    folded_folder.mkdir()
    folded = build(spark, folded_folder, *rows, collation="UTF8_LCASE")
    assert [r.newSR for r in runs.run_outcome(folded).selectExpr("SR as newSR").collect()] == [1]
    row = report.channel_report(folded).first()
    assert (row.disposition, row.agreementno, row.newSR, row.Provinsi) == ("READ", 1, 1, "P")
    assert report.best_media(folded).count() == 1


def test_other_stored_types(spark):
    activity = spark.createDataFrame(
        [("A1", "CAR", "3", datetime(2024, 3, 10, 9), "WHATSAPP", "READ")],
        "agreementno string, product string, assigned_dpd string, pt timestamp_ntz, agent_type string, disposition string",
    )
    for field in tables.ACTIVITY:
        if field.name not in activity.columns:
            activity = activity.selectExpr("*", f"cast(null as {field.dataType.simpleString()}) as {field.name}")
    loans = spark.createDataFrame(
        [("A1", datetime(2024, 3, 9, 1), 1, "NM", 5, 1.0, 2.0, "CAR")],
        "AgreementNo string, ReportDate timestamp_ntz, angsuran long, DefaultStatus string, "
        "DaysOverDueTolerance long, TotalOSPrincipal double, `Installment Amount Latest` double, Product string",
    )
    areas = spark.createDataFrame(
        [("A1", "P", "K", "C", "D", 1, 20240331)],
        "AgreementNo string, Provinsi string, Kab string, Kec string, Desa string, SubCGID int, SK_Time int",
    )
    campaign = Campaign.of(activity, loans, areas, AS_OF)
    row = runs.run_outcome(campaign).first()
    assert (row.min__pt, row.max__pt, row.DPD_Min, row.Provinsi) == (date(2024, 3, 10), date(2024, 3, 10), 5, "P")
    assert report.channel_report(campaign).first().newSR == 1


def test_catalog_tables(spark, tmp_path):
    paths = write_tables(tmp_path, [message()], [snapshot()], [area()])
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(f"stored_{name}")
    campaign = Campaign.from_catalog(spark, AS_OF, "stored_activity", "stored_loans", "stored_areas")
    assert report.channel_report(campaign).first().agreementno == 1


def test_three_part_names(spark, tmp_path):
    paths = write_tables(tmp_path, [message()], [snapshot()], [area()])
    names = {name: f"spark_catalog.default.kept_{name}" for name in paths}
    for name, path in paths.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(f"CREATE TABLE {names[name]} ({columns}) USING parquet LOCATION '{path}'")
    try:
        campaign = Campaign.from_catalog(spark, AS_OF, names["activity"], names["loans"], names["areas"])
        assert report.channel_report(campaign).first().agreementno == 1
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE {name}")


def test_products_and_channels_may_hold_any_text(spark, tmp_path):
    odd = {"product": "O'B. c", "agent_type": "W'A .x"}
    campaign = build(spark, tmp_path, [message(**odd), message()], [snapshot()], [area()])
    choices = {"products": ("CAR", "O'B. c"), "message_channels": ("WHATSAPP", "W'A .x")}
    campaign = replace(campaign, run_channels=("WHATSAPP", "W'A .x"), **choices)
    lines = report.channel_report(campaign)
    assert spark_rows(lines) == spark_rows(report.summarise(report.best_media(campaign)))
    assert {r.product for r in lines.collect()} == {"CAR", "O'B. c"}
    assert runs.run_spans(campaign).count() == 2


def test_one_spelling_under_a_collation(spark, tmp_path):
    rows = [message(product="car", agent_type="WhatsApp"), message(product="CAR", pt=date(2024, 3, 11))]
    folded = build(spark, tmp_path, rows, [snapshot(), snapshot(ReportDate=date(2024, 3, 10))], [area()], collation="UTF8_LCASE")
    lines = report.channel_report(folded)
    assert spark_rows(lines) == spark_rows(report.summarise(report.best_media(folded)))
    assert [(r.product, r.agent_type) for r in lines.collect()] == [("CAR", "WHATSAPP")]
    assert {r.product for r in runs.run_spans(folded).collect()} == {"CAR"}


def test_missing_column_is_an_error(spark):
    with pytest.raises(KeyError):
        tables.conform(spark.range(1), tables.LOANS)
