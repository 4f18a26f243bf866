"""Truth tables of the classifications and the success rules."""

from datetime import date

import pytest

from reachbook.functions import classify
from reachbook.operators import filters

SMS_FAILURES = ["REJECTED", "UNDELIV", "EXPIRED", "UNKNOWN", "BUFFERED", "UNDELIVRD", "REJECTD", "UNDELIVERD", "FAILED"]
# channel, disposition: contact group, funnel outcome, report outcome, rank letter
EXPECTED = {
    ("WHATSAPP", "REPLIED"): ("CONTACTED", "REPLIED", "READ", "A"),
    ("WHATSAPP", "READ"): ("CONTACTED", "READ", "READ", "B"),
    ("WHATSAPP", "DELIVERED"): ("CONTACTED", "DELIVERED", "DELIVERED", "C"),
    ("WHATSAPP", "SENT"): ("UNCONTACTED", "SENT", "FAILED", "D"),
    ("WHATSAPP", "SCHEDULED"): ("UNCONTACTED", "FAILED", "FAILED", "E"),
    ("WHATSAPP", "TRIGGERED"): ("UNCONTACTED", "FAILED", "FAILED", "F"),
    ("WHATSAPP", "FAILED"): ("UNCONTACTED", "FAILED", "FAILED", "G"),
    ("IVR", "ANSWERED"): ("CONTACTED", "ANSWERED", "ANSWERED", "A"),
    ("IVR", "NOT_ANSWERED"): ("UNCONTACTED", "NOT_ANSWERED", "NOT_ANSWERED", "B"),
    ("IVR", "FAILED"): ("UNCONTACTED", "FAILED", "FAILED", "C"),
    ("SMS", "DELIVERED"): ("CONTACTED", "DELIVERED", "SENT", "A"),
    ("SMS", "SENT"): ("CONTACTED", "SENT", "SENT", "B"),
    **{("SMS", d): ("UNCONTACTED", "NOT SENT", "FAILED", chr(ord("C") + i)) for i, d in enumerate(SMS_FAILURES)},
    # Unlisted, unknown, or listed for another channel only.
    **{pair: ("UNCONTACTED", None, None, None) for pair in [
        ("WHATSAPP", "ODD"), ("IVR", "ODD"), ("SMS", "ODD"), ("WHATSAPP", None), ("IVR", None), ("SMS", None),
        ("DIGITAL", "READ"), ("FIELD", "FAILED"), (None, "READ"), (None, None), ("IVR", "READ"), ("SMS", "REPLIED"),
        ("WHATSAPP", "ANSWERED"), ("WHATSAPP", "read"),
    ]},
}


def test_dispositions(spark):
    pairs = spark.createDataFrame(list(EXPECTED), "agent_type string, disposition string")
    rows = pairs.select(
        "agent_type",
        "disposition",
        classify.grouped_disposition(),
        classify.funnel_outcome(),
        classify.report_outcome(),
        classify.rank_letter(),
    ).collect()
    assert {tuple(r[:2]): tuple(r[2:]) for r in rows} == EXPECTED


def test_rank_gives_back_the_report_outcome(spark):
    pairs = spark.createDataFrame(list(EXPECTED), "agent_type string, disposition string")
    ranked = pairs.withColumn("rank", classify.outcome_rank()).withColumn("reported", classify.report_outcome())
    rows = ranked.select("reported", classify.report_outcome_of_rank("agent_type", "rank")).collect()
    assert all(r[0] == r[1] for r in rows)


STAGE_ORDER = list(classify.STAGES)
# channel, funnel outcome, number: the stage labels that are not NULL
STAGE_CASES = [
    ("WHATSAPP", "DELIVERED", "62", ["Bahan WA", "Sent", "Delivered", "Not Read", "Not Replied"]),
    ("WHATSAPP", "FAILED", None, ["Bahan WA", "Not Sent", "Not Delivered", "Not Read", "Not Replied"]),
    ("WHATSAPP", "READ", None, ["Bahan WA", "Sent", "Delivered", "Read", "Not Replied"]),
    ("WHATSAPP", "REPLIED", None, ["Bahan WA", "Sent", "Delivered", "Read", "Replied"]),
    ("WHATSAPP", "SENT", None, ["Bahan WA", "Sent", "Not Delivered", "Not Read", "Not Replied"]),
    ("WHATSAPP", None, None, [None] * 5),
    ("IVR", "ANSWERED", "62", ["Dial IVR", "Connected", "Answered"]),
    ("IVR", "NOT_ANSWERED", "628", ["Dial IVR", "Connected", "Not Answered"]),
    ("IVR", "NOT_ANSWERED", "62", ["Dial IVR", "Not Connected", "Not Answered"]),
    ("IVR", "NOT_ANSWERED", None, ["Dial IVR", None, "Not Answered"]),
    ("IVR", "FAILED", "628", ["Dial IVR", "Not Connected", "Not Answered"]),
    ("IVR", None, "628", [None] * 3),
    ("SMS", "DELIVERED", None, ["Triggered SMS", "Sent"]),
    ("SMS", "SENT", None, ["Triggered SMS", "Sent"]),
    ("SMS", "NOT SENT", None, ["Triggered SMS", "Not Sent"]),
    ("SMS", None, None, [None] * 2),
    ("FIELD", "SENT", None, []),
]


def test_funnel_stages(spark):
    frame = spark.createDataFrame(
        [c[:3] for c in STAGE_CASES], "agent_type string, Disposition_NEW string, contact_number string"
    )
    spans = {"WHATSAPP": slice(0, 5), "IVR": slice(5, 8), "SMS": slice(8, 10), "FIELD": slice(0, 0)}
    for case, row in zip(STAGE_CASES, frame.select(*classify.stage_columns().values()).collect(), strict=True):
        expected = [None] * len(STAGE_ORDER)
        expected[spans[case[0]]] = case[3]
        assert list(row) == expected, case


def test_run_success(spark):
    days = spark.createDataFrame([(0,), (5,), (None,)], "d int")
    assert [r[0] for r in days.select(classify.run_success("d")).collect()] == [1, 0, 1]


GRACE = {(0, None): 1, (5, None): 0, (None, None): 1, (0, "SMS"): 0, (5, "SMS"): 0, (None, "SMS"): 0}


@pytest.mark.parametrize("sr", [0, 1])
def test_grace_and_final_success(spark, sr):
    today, past = date(2024, 3, 10), date(2024, 3, 5)
    frame = spark.createDataFrame(
        [(sr, dpd, agent, day) for dpd, agent in GRACE for day in (past, today)],
        "SR int, DPD_Max_2 int, agent_type string, max__pt_1 date",
    )
    rows = frame.select(
        "DPD_Max_2", "agent_type", "max__pt_1", classify.grace_success(), classify.final_success(today)
    ).collect()
    for dpd, agent, day, grace, final in rows:
        expected = GRACE[(dpd, agent)] if sr == 0 else 0
        assert grace == expected
        assert final == (expected if sr == 0 and day == past else sr)


def test_assigned_days_are_compared_as_text(spark):
    texts = ["0", "-1", "1", "00", "", "-", None, "10"]
    frame = spark.createDataFrame([(t,) for t in texts], "assigned_dpd string")
    assert [r[0] for r in frame.where(filters.positive_dpd()).collect()] == ["1", "00", "", "10"]


def test_status_filters_drop_unknown(spark):
    frame = spark.createDataFrame([("NM",), ("WO",), ("XX",), (None,)], "DefaultStatus string")
    assert [r[0] for r in frame.where(filters.status_normal()).collect()] == ["NM"]
    assert [r[0] for r in frame.where(filters.not_written_off()).collect()] == ["NM", "XX"]
