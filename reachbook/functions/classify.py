"""Message classification: outcome tables and the success rules."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channels, products and statuses the reports are defined on.
WHATSAPP, IVR, SMS, DIGITAL = "WHATSAPP", "IVR", "SMS", "DIGITAL"
RUN_CHANNELS = (WHATSAPP, IVR, SMS, DIGITAL)
MESSAGE_CHANNELS = (WHATSAPP, IVR, SMS)
PRODUCTS = ("CAR", "MCY")
STATUS_NORMAL = "NM"
STATUS_WRITTEN_OFF = "WO"
CONTACTED, UNCONTACTED = "CONTACTED", "UNCONTACTED"
NO_NUMBER = "62"

# Dispositions that count as a contact.
CONTACT_DISPOSITIONS = {
    WHATSAPP: ("DELIVERED", "READ", "REPLIED"),
    IVR: ("ANSWERED",),
    SMS: ("SENT", "DELIVERED"),
}

# Per channel, best disposition first,
# disposition: (funnel outcome, report outcome, rank letter).
OUTCOMES = {
    WHATSAPP: {
        "REPLIED": ("REPLIED", "READ", "A"),
        "READ": ("READ", "READ", "B"),
        "DELIVERED": ("DELIVERED", "DELIVERED", "C"),
        "SENT": ("SENT", "FAILED", "D"),
        "SCHEDULED": ("FAILED", "FAILED", "E"),
        "TRIGGERED": ("FAILED", "FAILED", "F"),
        "FAILED": ("FAILED", "FAILED", "G"),
    },
    IVR: {
        "ANSWERED": ("ANSWERED", "ANSWERED", "A"),
        "NOT_ANSWERED": ("NOT_ANSWERED", "NOT_ANSWERED", "B"),
        "FAILED": ("FAILED", "FAILED", "C"),
    },
    SMS: {
        "DELIVERED": ("DELIVERED", "SENT", "A"),
        "SENT": ("SENT", "SENT", "B"),
        "REJECTED": ("NOT SENT", "FAILED", "C"),
        "UNDELIV": ("NOT SENT", "FAILED", "D"),
        "EXPIRED": ("NOT SENT", "FAILED", "E"),
        "UNKNOWN": ("NOT SENT", "FAILED", "F"),
        "BUFFERED": ("NOT SENT", "FAILED", "G"),
        "UNDELIVRD": ("NOT SENT", "FAILED", "H"),
        "REJECTD": ("NOT SENT", "FAILED", "I"),
        "UNDELIVERD": ("NOT SENT", "FAILED", "J"),
        "FAILED": ("NOT SENT", "FAILED", "K"),
    },
}


def as_listed(column: str, values: Iterable[str]) -> Column:
    """The value in the spelling of the list, as a collation may match others."""
    return F.coalesce(*[F.when(F.col(column) == value, value) for value in values], F.col(column))


# Funnel stage columns, channel and label per funnel outcome.
# The IVR connection of an unanswered call also depends on the number dialled.
STAGES = {
    "Disposition_BahanWA": (WHATSAPP, {"Bahan WA": ("DELIVERED", "FAILED", "READ", "REPLIED", "SENT")}),
    "Disposition_SentWA": (WHATSAPP, {"Sent": ("DELIVERED", "READ", "REPLIED", "SENT"), "Not Sent": ("FAILED",)}),
    "Disposition_DeliveredWA": (
        WHATSAPP,
        {"Delivered": ("DELIVERED", "READ", "REPLIED"), "Not Delivered": ("FAILED", "SENT")},
    ),
    "Disposition_ReadWA": (WHATSAPP, {"Read": ("READ", "REPLIED"), "Not Read": ("DELIVERED", "FAILED", "SENT")}),
    "Disposition_RepliedWA": (
        WHATSAPP,
        {"Replied": ("REPLIED",), "Not Replied": ("DELIVERED", "FAILED", "READ", "SENT")},
    ),
    "Disposition_DialIVR": (IVR, {"Dial IVR": ("ANSWERED", "NOT_ANSWERED", "FAILED")}),
    "Disposition_ConnectedIVR": (IVR, {"Connected": ("ANSWERED",), "Not Connected": ("FAILED",)}),
    "Disposition_AnsweredIVR": (IVR, {"Answered": ("ANSWERED",), "Not Answered": ("NOT_ANSWERED", "FAILED")}),
    "Disposition_TriggeredSMS": (SMS, {"Triggered SMS": ("DELIVERED", "SENT", "NOT SENT")}),
    "Disposition_SentSMS": (SMS, {"Sent": ("DELIVERED", "SENT"), "Not Sent": ("NOT SENT",)}),
}


def _listed(values: Iterable[str | int]) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _case(branches: list[tuple[str, str]], otherwise: str = "NULL") -> Column:
    """CASE over (condition, text) branches, as one SQL expression."""
    whens = " ".join(f"WHEN {condition} THEN '{value}'" for condition, value in branches)
    return F.expr(f"CASE {whens} ELSE {otherwise} END")


def _outcome_branches(field: int) -> list[tuple[str, str]]:
    """Per channel and value of one OUTCOMES field: the dispositions that give it."""
    branches = []
    for channel, dispositions in OUTCOMES.items():
        raw_by_value: dict[str, list[str]] = {}
        for raw, fields in dispositions.items():
            raw_by_value.setdefault(fields[field], []).append(raw)
        for value, raw in raw_by_value.items():
            branches.append((f"agent_type = '{channel}' AND disposition IN ({_listed(raw)})", value))
    return branches


def grouped_disposition() -> Column:
    """CONTACTED when the customer was reached, else UNCONTACTED."""
    reached = [
        (f"agent_type = '{channel}' AND disposition IN ({_listed(raw)})", CONTACTED)
        for channel, raw in CONTACT_DISPOSITIONS.items()
    ]
    return _case(reached, otherwise=f"'{UNCONTACTED}'")


def funnel_outcome() -> Column:
    return _case(_outcome_branches(0))


def report_outcome() -> Column:
    return _case(_outcome_branches(1))


def rank_letter() -> Column:
    """A for the best disposition of the row's channel; NULL when unlisted."""
    return _case(_outcome_branches(2))


def rank_number(letter: str) -> int:
    return ord(letter) - ord("A") + 1


def outcome_rank() -> Column:
    """The rank letter as a number from 1, NULL when the disposition is unlisted."""
    return F.ascii(rank_letter()) - (ord("A") - 1)


def report_outcome_of_rank(channel: str, rank: str) -> Column:
    """Report outcome from a channel and an outcome_rank, NULL for no rank."""
    branches = []
    for name, dispositions in OUTCOMES.items():
        ranks: dict[str, list[int]] = {}
        for _, reported, letter in dispositions.values():
            ranks.setdefault(reported, []).append(rank_number(letter))
        for reported, numbers in ranks.items():
            branches.append((f"{channel} = '{name}' AND {rank} IN ({_listed(numbers)})", reported))
    return _case(branches)


def stage_columns() -> dict[str, Column]:
    """The ten funnel stage flags, from channel, Disposition_NEW and number."""
    columns = {}
    for name, (channel, labels) in STAGES.items():
        branches = [
            (f"agent_type = '{channel}' AND Disposition_NEW IN ({_listed(outcomes)})", label)
            for label, outcomes in labels.items()
        ]
        if name == "Disposition_ConnectedIVR":
            unanswered = f"agent_type = '{channel}' AND Disposition_NEW = 'NOT_ANSWERED' AND contact_number"
            branches += [
                (f"{unanswered} <> '{NO_NUMBER}'", "Connected"),
                (f"{unanswered} = '{NO_NUMBER}'", "Not Connected"),
            ]
        columns[name] = _case(branches)
    return columns


def run_success(days_overdue: str) -> Column:
    """1 unless the agreement is still overdue; leaving the loan book counts as 1."""
    return F.when(F.col(days_overdue) != 0, 0).otherwise(1)


def grace_success() -> Column:
    """Success one day later, credited only if nobody contacted the customer then."""
    recovered = F.coalesce(F.col("DPD_Max_2") == 0, F.lit(True))
    return F.when((F.col("SR") == 0) & F.col("agent_type").isNull() & recovered, 1).otherwise(0)


def final_success(today: date) -> Column:
    """The grace rule where its day is over, the plain result otherwise."""
    grace_over = (F.col("SR") == 0) & (F.col("max__pt_1") != F.lit(today))
    return F.when(grace_over, grace_success()).otherwise(F.col("SR"))
