"""Independent DuckDB SQL for every query, used to check the Spark results.

The statements follow the definitions directly: every lookup is a join, every
pick a numbered window, the final outcome a union of three branches. They share
nothing with the package but the moment of the report: the date bounds are taken
from it in SQL, so a rewrite there cannot hide an error here.
"""

from __future__ import annotations

from reachbook.functions.calendar import AsOf

# The three input tables from the driver's tables, trailing blanks cut.
TABLES = """
activity AS (
  SELECT rtrim(CASE WHEN user_id % 50 = 49 THEN ' ' ELSE '' END || 'AG' || lpad(CAST(user_id AS VARCHAR), 8, '0')) AS agreementno,
         CASE WHEN user_id % 10 = 0 THEN 'HOME' WHEN user_id % 2 = 1 THEN 'MCY' ELSE 'CAR' END AS product,
         CASE event_id % 9 WHEN 0 THEN '0' WHEN 1 THEN '-3' ELSE CAST(event_id % 9 AS VARCHAR) END AS assigned_dpd,
         CAST(ts AS DATE) AS assigned_date,
         ts AS activity_date,
         'A' || CAST(event_id % 17 AS VARCHAR) AS agent_id,
         CASE event_type WHEN 'click' THEN 'WHATSAPP' WHEN 'view' THEN 'IVR' WHEN 'signup' THEN 'SMS'
                         WHEN 'purchase' THEN 'DIGITAL'
                         WHEN 'error' THEN CASE WHEN event_id % 13 <> 0 THEN 'FIELD' END END AS agent_type,
         CASE event_type
              WHEN 'click' THEN CASE WHEN event_id % 41 = 0 THEN 'BOUNCED' ELSE
                   (['REPLIED','READ','DELIVERED','SENT','SCHEDULED','TRIGGERED','FAILED'])[CAST(event_id % 7 AS INTEGER) + 1] END
              WHEN 'view' THEN CASE WHEN event_id % 41 = 0 THEN 'BUSY' ELSE
                   (['ANSWERED','NOT_ANSWERED','FAILED'])[CAST(event_id % 3 AS INTEGER) + 1] END
              WHEN 'signup' THEN CASE WHEN event_id % 41 = 0 THEN 'QUEUED' ELSE
                   (['DELIVERED','SENT','REJECTED','UNDELIV','EXPIRED','UNKNOWN','BUFFERED','UNDELIVRD','REJECTD',
                     'UNDELIVERD','FAILED'])[CAST(event_id % 11 AS INTEGER) + 1] END
              ELSE 'OTHER' END AS disposition,
         CASE WHEN event_id % 5 = 0 THEN '62' WHEN event_id % 23 = 0 THEN NULL
              ELSE '62' || CAST(800000 + user_id AS VARCHAR) END AS contact_number,
         'P' || CAST(event_id % 3 AS VARCHAR) AS persona_name,
         CASE WHEN event_id % 2 = 0 THEN 'SELF' ELSE 'FAMILY' END AS contact_type,
         CAST(user_id % 6 AS INTEGER) AS subcgid,
         CAST(ts AS DATE) AS pt
  FROM events),
user_days AS (
  SELECT u, d - 1 AS rd, date_diff('day', DATE '2024-01-01', d) AS n
  FROM (SELECT DISTINCT user_id AS u FROM events) CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)),
single AS (
  SELECT u, 'AG' || lpad(CAST(u AS VARCHAR), 8, '0') AS AgreementNo,
         rd AS ReportDate,
         CAST(1 + u % 24 + CASE WHEN n >= 15 THEN 1 ELSE 0 END AS INTEGER) AS angsuran,
         CASE WHEN u % 8 = 7 THEN 'WO' WHEN u % 16 = 3 THEN NULL WHEN u % 16 = 9 THEN 'RS' ELSE 'NM' END AS DefaultStatus,
         CAST(CASE WHEN (u + n) % 5 = 0 THEN 0 ELSE (u * 3 + n) % 90 END AS INTEGER) AS DaysOverDueTolerance,
         CAST(1000000 + u * 1250.5 AS DECIMAL(18,2)) AS TotalOSPrincipal,
         CAST(250000 + u * 10.25 AS DECIMAL(18,2)) AS "Installment Amount Latest",
         CASE WHEN u % 2 = 1 THEN 'MCY' ELSE 'CAR' END AS Product
  FROM user_days WHERE (u * 7 + n * 3) % 11 <> 0),
list AS (
  SELECT * EXCLUDE (u) FROM single
  UNION ALL
  SELECT * EXCLUDE (u) REPLACE (DaysOverDueTolerance + 1 AS DaysOverDueTolerance)
  FROM single WHERE u % 37 = 5 AND day(ReportDate) % 10 = 4),
provinsi AS (
  SELECT 'AG' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS AgreementNo, r_name AS Provinsi, n_name AS Kab,
         c_mktsegment AS Kec, 'Desa ' || CAST(c_custkey % 20 AS VARCHAR) AS Desa,
         CAST(c_custkey % 6 AS INTEGER) AS SubCGID, sk AS SK_Time
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
       CROSS JOIN (VALUES ('20240131'), ('20231231')) AS snapshot(sk)
  WHERE c_custkey IN (SELECT user_id FROM events) AND c_custkey % 12 <> 5)"""

# Channel, raw disposition, funnel outcome, report outcome, rank letter.
CODES = """
codes(chan, raw, stage, reported, letter) AS (VALUES
  ('WHATSAPP', 'REPLIED', 'REPLIED', 'READ', 'A'),
  ('WHATSAPP', 'READ', 'READ', 'READ', 'B'),
  ('WHATSAPP', 'DELIVERED', 'DELIVERED', 'DELIVERED', 'C'),
  ('WHATSAPP', 'SENT', 'SENT', 'FAILED', 'D'),
  ('WHATSAPP', 'SCHEDULED', 'FAILED', 'FAILED', 'E'),
  ('WHATSAPP', 'TRIGGERED', 'FAILED', 'FAILED', 'F'),
  ('WHATSAPP', 'FAILED', 'FAILED', 'FAILED', 'G'),
  ('IVR', 'ANSWERED', 'ANSWERED', 'ANSWERED', 'A'),
  ('IVR', 'NOT_ANSWERED', 'NOT_ANSWERED', 'NOT_ANSWERED', 'B'),
  ('IVR', 'FAILED', 'FAILED', 'FAILED', 'C'),
  ('SMS', 'DELIVERED', 'DELIVERED', 'SENT', 'A'),
  ('SMS', 'SENT', 'SENT', 'SENT', 'B'),
  ('SMS', 'REJECTED', 'NOT SENT', 'FAILED', 'C'),
  ('SMS', 'UNDELIV', 'NOT SENT', 'FAILED', 'D'),
  ('SMS', 'EXPIRED', 'NOT SENT', 'FAILED', 'E'),
  ('SMS', 'UNKNOWN', 'NOT SENT', 'FAILED', 'F'),
  ('SMS', 'BUFFERED', 'NOT SENT', 'FAILED', 'G'),
  ('SMS', 'UNDELIVRD', 'NOT SENT', 'FAILED', 'H'),
  ('SMS', 'REJECTD', 'NOT SENT', 'FAILED', 'I'),
  ('SMS', 'UNDELIVERD', 'NOT SENT', 'FAILED', 'J'),
  ('SMS', 'FAILED', 'NOT SENT', 'FAILED', 'K')),
reached(chan, raw) AS (VALUES
  ('WHATSAPP', 'DELIVERED'), ('WHATSAPP', 'READ'), ('WHATSAPP', 'REPLIED'), ('IVR', 'ANSWERED'),
  ('SMS', 'SENT'), ('SMS', 'DELIVERED'))"""

INTEGERS = {
    "angsuran", "subcgid", "SubCGID", "DaysOverDueTolerance", "DPD_Min", "DPD_Max", "DPD_Max_1", "DPD_Max_2", "SR",
    "newSR", "rownum", "rn", "row_num", "rn_wa", "rn_ivr", "rn_sms", "row_number", "messages", "is_message",
}
DOUBLES = {"TotalOSPrincipal", "Installment Amount Latest", "osp", "installment_amount"}
DAYS = {
    "assigned_date", "pt", "ReportDate", "min__pt", "max__pt", "max__pt_1", "month_start", "prior_month_end",
    "month_end", "today", "yesterday", "day_before", "day_after", "day", "first_day", "day_before_first", "last_day",
}

RUN = "agreementno, product, angsuran, min__pt, max__pt"
READINGS = (
    "DPD_Min, DPD_Max, DPD_Max_1, TotalOSPrincipal, Installment Amount Latest, DefaultStatus, Provinsi, Kab, Kec, Desa"
)
OUTCOME = f"{RUN}, {READINGS}, SR, rownum"
NEXT_DAY = f"{OUTCOME}, nomor_kontrak, osp, DPD_Max_2, installment_amount, ReportDate, Dummy, max__pt_1"
CONTACT = f"{NEXT_DAY}, no_kontrak, agent_type, pt"
BLAST = f"{RUN}, Grouped_Disposition, {READINGS}, SR, rownum"
BLAST_OUTCOME = f"{BLAST}, newSR, max__pt_1, DPD_Max_2, agent_type"
MESSAGE = (
    "agreementno, assigned_dpd, activity_date, agent_id, agent_type, product, disposition, contact_number, "
    "Grouped_Disposition, persona_name, contact_type, pt, Provinsi, Desa, Kab, Kec, angsuran"
)
FUNNEL = f"{MESSAGE}, assigned_date"
FUNNEL_OUTCOME = f"{MESSAGE}, newSR, TotalOSPrincipal, max__pt_1, DPD_Max_2, Disposition_NEW"
MEDIA = f"{FUNNEL_OUTCOME}, disposition2"
STAGES = (
    "Disposition_BahanWA, Disposition_SentWA, Disposition_DeliveredWA, Disposition_ReadWA, Disposition_RepliedWA, "
    "Disposition_DialIVR, Disposition_ConnectedIVR, Disposition_AnsweredIVR, Disposition_TriggeredSMS, "
    "Disposition_SentSMS"
)


def _names(columns: str) -> list[str]:
    return columns.split(", ")


def _plain(columns: str) -> str:
    """Select list in the plain types both engines hand over alike."""
    out = []
    for name in _names(columns):
        value = f'"{name}"'
        if name in INTEGERS:
            value = f"CAST({value} AS BIGINT)"
        elif name in DOUBLES:
            value = f"CAST({value} AS DOUBLE)"
        elif name in DAYS:
            value = f"strftime({value}, '%Y-%m-%d')"
        elif name == "activity_date":
            value = f"strftime({value}, '%Y-%m-%d %H:%M:%S.%f')"
        out.append(f'{value} AS "{name}"')
    return ", ".join(out)


def _order(columns: str, *done: str) -> str:
    """Every column not yet ordered by, NULLs first."""
    return ", ".join(f'"{c}" ASC NULLS FIRST' for c in _names(columns) if c not in done)


def _judged(name: str, spans: str, extra: str) -> str:
    columns = f"product, angsuran, min__pt{extra}, {READINGS}"
    return f"""
{name}_read AS (
  SELECT s.*, a.DaysOverDueTolerance AS DPD_Min, b.DaysOverDueTolerance AS DPD_Max,
         c.DaysOverDueTolerance AS DPD_Max_1, a.TotalOSPrincipal, a."Installment Amount Latest", a.DefaultStatus,
         h.Provinsi, h.Kab, h.Kec, h.Desa,
         CASE WHEN c.DaysOverDueTolerance IS NULL OR c.DaysOverDueTolerance = 0 THEN 1 ELSE 0 END AS SR
  FROM {spans} s
       LEFT JOIN book a ON a.k = trim(s.agreementno) AND a.ReportDate = s.min__pt - 1
       LEFT JOIN book b ON b.k = trim(s.agreementno) AND b.ReportDate = s.max__pt - 1
       LEFT JOIN book c ON c.k = trim(s.agreementno) AND c.ReportDate = s.max__pt
       LEFT JOIN homes h ON h.k = trim(s.agreementno)),
{name} AS (
  SELECT *, row_number() OVER (PARTITION BY agreementno ORDER BY max__pt ASC NULLS FIRST, {_order(columns)}) AS rownum
  FROM {name}_read)"""


def _bounds(as_of: AsOf) -> dict[str, str]:
    """Every date bound as an expression of the moment."""
    moment = f"TIMESTAMP '{as_of.moment}'"
    cutoff = f"({moment} - INTERVAL 1 DAY)"
    start = f"CAST(date_trunc('month', {cutoff}) AS DATE)"
    month_end = f"last_day(CAST({cutoff} AS DATE))"
    return {
        "today": f"CAST({moment} AS DATE)",
        "cutoff": cutoff,
        "yesterday": f"CAST({cutoff} AS DATE)",
        "start": start,
        "prior_end": f"({start} - 1)",
        "month_end": month_end,
        "key": f"strftime({month_end}, '%Y%m%d')",
    }


def _datasets(as_of: AsOf, unmapped: str) -> str:
    at = _bounds(as_of)
    media_order = "product, Provinsi, Desa, Kab, Kec, newSR"
    rest = _order(MEDIA, *_names(media_order), "agreementno", "angsuran", "agent_type", "Disposition_NEW", "disposition2")
    reached = "EXISTS (SELECT 1 FROM reached r WHERE r.chan = x.agent_type AND r.raw = x.disposition)"
    return f"""
book AS (
  SELECT *, trim(AgreementNo) AS k FROM list
  WHERE ReportDate >= {at['prior_end']} AND ReportDate <= {at['cutoff']}),
sent AS (
  SELECT x.*, trim(x.agreementno) AS k,
         CASE WHEN {reached} THEN 'CONTACTED' ELSE 'UNCONTACTED' END AS Grouped_Disposition
  FROM activity x WHERE pt >= {at['start']} AND pt <= {at['cutoff']}),
homes AS (
  SELECT *, trim(AgreementNo) AS k FROM provinsi WHERE SK_Time = {at['key']}),
qualified AS (
  SELECT m.*, l.angsuran, l.DefaultStatus
  FROM sent m JOIN book l ON l.AgreementNo = m.agreementno AND l.ReportDate = m.pt - 1
  WHERE m.agent_type IN ('WHATSAPP', 'IVR', 'SMS', 'DIGITAL') AND m.product IN ('CAR', 'MCY')
        AND m.assigned_dpd <> '0' AND m.assigned_dpd NOT LIKE '-%' AND l.DefaultStatus = 'NM'),
spans AS (
  SELECT agreementno, product, angsuran, min(pt) AS min__pt, max(pt) AS max__pt
  FROM qualified GROUP BY agreementno, product, angsuran),
blast_spans AS (
  SELECT agreementno, product, angsuran, min(pt) AS min__pt, max(pt) AS max__pt, Grouped_Disposition
  FROM qualified WHERE agent_type <> 'DIGITAL' GROUP BY agreementno, product, angsuran, Grouped_Disposition),
{_judged("outcome", "spans", "").strip()},
next_day AS (
  SELECT o.*, l.AgreementNo AS nomor_kontrak, l.TotalOSPrincipal AS osp, l.DaysOverDueTolerance AS DPD_Max_2,
         l."Installment Amount Latest" AS installment_amount, l.ReportDate,
         concat(o.agreementno, o.angsuran) AS Dummy, o.max__pt + 1 AS max__pt_1
  FROM outcome o LEFT JOIN book l ON l.k = trim(o.agreementno) AND l.ReportDate = o.max__pt + 1),
contact_order AS (
  SELECT agreementno, agent_type, pt,
         row_number() OVER (PARTITION BY agreementno, pt ORDER BY agent_type ASC NULLS FIRST) AS n
  FROM sent),
contacts AS (SELECT agreementno, agent_type, pt FROM contact_order WHERE n = 1),
contact AS (
  SELECT d.*, c.agreementno AS no_kontrak, c.agent_type, c.pt
  FROM next_day d LEFT JOIN contacts c ON trim(c.agreementno) = trim(d.agreementno) AND c.pt = d.max__pt_1),
graced AS (
  SELECT *, CASE WHEN agent_type IS NULL AND coalesce(DPD_Max_2, 0) = 0 THEN 1 ELSE 0 END AS newSR
  FROM contact WHERE SR = 0 AND max__pt_1 <> {at['today']}),
branches AS (
  SELECT *, 'SR0' AS branch FROM graced
  UNION ALL
  SELECT *, SR AS newSR, 'SR01' AS branch FROM contact WHERE SR = 0 AND max__pt_1 = {at['today']}
  UNION ALL
  SELECT *, SR AS newSR, 'SR1' AS branch FROM contact WHERE SR = 1),
agreement_order AS (
  SELECT *, row_number() OVER (PARTITION BY agreementno ORDER BY newSR DESC NULLS LAST,
                               {_order(CONTACT, "agreementno")}) AS rn
  FROM branches),
{_judged("blast", "blast_spans", ", Grouped_Disposition").strip()},
blast_outcome AS (
  SELECT b.*, o.newSR, o.max__pt_1, o.DPD_Max_2, o.agent_type
  FROM blast b LEFT JOIN branches o ON o.agreementno = b.agreementno AND o.angsuran = b.angsuran),
blast_order AS (
  SELECT *, row_number() OVER (PARTITION BY agreementno, angsuran ORDER BY Grouped_Disposition ASC NULLS FIRST,
                               {_order(BLAST_OUTCOME, "agreementno", "angsuran", "Grouped_Disposition")}) AS row_num
  FROM blast_outcome),
funnel AS (
  SELECT m.* REPLACE (m.k AS agreementno), h.Provinsi, h.Desa, h.Kab, h.Kec, l.angsuran
  FROM sent m JOIN book l ON l.k = m.k AND l.ReportDate = m.pt - 1 LEFT JOIN homes h ON h.k = m.k
  WHERE m.product IN ('CAR', 'MCY') AND m.agent_type IN ('WHATSAPP', 'IVR', 'SMS') AND l.DefaultStatus <> 'WO'),
media AS (
  SELECT f.*, o.newSR, o.TotalOSPrincipal, o.max__pt_1, o.DPD_Max_2,
         c.stage AS Disposition_NEW, c.reported AS disposition2, c.letter
  FROM funnel f
       LEFT JOIN branches o ON o.agreementno = f.agreementno AND o.angsuran = f.angsuran
       LEFT JOIN codes c ON c.chan = f.agent_type AND c.raw = f.disposition),
media_order AS (
  SELECT *, row_number() OVER (PARTITION BY agent_type, agreementno, angsuran
                               ORDER BY letter ASC NULLS {unmapped}, {_order(media_order)}, {rest}) AS n
  FROM media),
best AS (SELECT *, letter AS dispositionwa, n AS rn_wa FROM media_order WHERE n = 1)"""


def _stage(name: str, channel: str, **labels: str) -> str:
    cases = " ".join(
        f"WHEN agent_type = '{channel}' AND Disposition_NEW IN ({values}) THEN '{label.replace('_', ' ')}'"
        for label, values in labels.items()
    )
    return f"CASE {cases} END AS {name}"


def _stages() -> str:
    every = "'DELIVERED', 'FAILED', 'READ', 'REPLIED', 'SENT'"
    return ", ".join(
        [
            _stage("Disposition_BahanWA", "WHATSAPP", Bahan_WA=every),
            _stage("Disposition_SentWA", "WHATSAPP", Not_Sent="'FAILED'", Sent=every),
            _stage("Disposition_DeliveredWA", "WHATSAPP", Not_Delivered="'FAILED', 'SENT'", Delivered=every),
            _stage("Disposition_ReadWA", "WHATSAPP", Read="'READ', 'REPLIED'", Not_Read=every),
            _stage("Disposition_RepliedWA", "WHATSAPP", Replied="'REPLIED'", Not_Replied=every),
            _stage("Disposition_DialIVR", "IVR", Dial_IVR="'ANSWERED', 'NOT_ANSWERED', 'FAILED'"),
            """CASE WHEN agent_type <> 'IVR' THEN NULL WHEN Disposition_NEW = 'ANSWERED' THEN 'Connected'
                    WHEN Disposition_NEW = 'FAILED' OR (Disposition_NEW = 'NOT_ANSWERED' AND contact_number = '62')
                    THEN 'Not Connected'
                    WHEN Disposition_NEW = 'NOT_ANSWERED' AND contact_number IS NOT NULL THEN 'Connected'
               END AS Disposition_ConnectedIVR""",
            _stage("Disposition_AnsweredIVR", "IVR", Answered="'ANSWERED'", Not_Answered="'NOT_ANSWERED', 'FAILED'"),
            _stage("Disposition_TriggeredSMS", "SMS", Triggered_SMS="'DELIVERED', 'SENT', 'NOT SENT'"),
            _stage("Disposition_SentSMS", "SMS", Sent="'DELIVERED', 'SENT'", Not_Sent="'NOT SENT'"),
        ]
    )


def _selects(as_of: AsOf) -> dict[str, str]:
    def of(columns: str, relation: str, where: str = "TRUE") -> str:
        return f"SELECT {_plain(columns)} FROM {relation} WHERE {where}"

    at = _bounds(as_of)
    lookups = """(SELECT s.*, a.DaysOverDueTolerance AS {name}, a.TotalOSPrincipal, a."Installment Amount Latest",
                         a.DefaultStatus
                  FROM spans s LEFT JOIN book a ON a.k = trim(s.agreementno) AND a.ReportDate = {day})"""
    best = {}
    for key, channel, suffix in (("whatsapp", "WHATSAPP", "wa"), ("ivr", "IVR", "ivr"), ("sms", "SMS", "sms")):
        relation = f"(SELECT *, letter AS disposition{suffix}, n AS rn_{suffix} FROM media_order)"
        columns = f"{MEDIA}, disposition{suffix}, rn_{suffix}"
        best[f"w_best_{key}"] = of(columns, relation, f"agent_type = '{channel}' AND n = 1")
        best[f"w_rank_{key}"] = of(columns, relation, f"agent_type = '{channel}'")
    return {
        "s_activity": of(
            "agreementno, product, assigned_dpd, assigned_date, activity_date, agent_id, agent_type, disposition, "
            "contact_number, persona_name, contact_type, subcgid, pt",
            "activity",
        ),
        "s_list": of(
            "AgreementNo, ReportDate, angsuran, DefaultStatus, DaysOverDueTolerance, TotalOSPrincipal, "
            "Installment Amount Latest, Product",
            "list",
        ),
        "s_provinsi": of("AgreementNo, Provinsi, Kab, Kec, Desa, SubCGID, SK_Time", "provinsi"),
        "p_rename_lookup": of("agreementno, angsuran, nomor_kontrak, osp, DPD_Max_2, installment_amount", "next_day"),
        "p_composite_key": of("agreementno, angsuran, Dummy", "next_day"),
        "p_next_day": of("agreementno, angsuran, max__pt, max__pt_1", "next_day"),
        "f_month_to_date": of("agreementno, activity_date, pt", "sent"),
        "f_snapshot_window": of("AgreementNo, ReportDate, DaysOverDueTolerance", "book"),
        "f_month_end_snapshot": of("AgreementNo, Provinsi, Kab, Kec, Desa, SK_Time", "homes"),
        "f_channel_in": of(
            "agreementno, activity_date, product, agent_type, is_message",
            "(SELECT *, agent_type <> 'DIGITAL' AS is_message FROM activity)",
            "agent_type IN ('WHATSAPP', 'IVR', 'SMS', 'DIGITAL') AND product IN ('CAR', 'MCY')",
        ),
        "f_positive_dpd": of(
            "agreementno, activity_date, assigned_dpd", "activity", "assigned_dpd <> '0' AND left(assigned_dpd, 1) <> '-'"
        ),
        "f_status_normal": of("AgreementNo, ReportDate, DefaultStatus", "list", "DefaultStatus = 'NM'"),
        "f_not_written_off": of("AgreementNo, ReportDate, DefaultStatus", "list", "DefaultStatus <> 'WO'"),
        "j_installment_prev_day": of(
            "agreementno, product, assigned_dpd, pt, subcgid, disposition, angsuran, DefaultStatus", "qualified"
        ),
        "j_lookup_before_first": of(
            f"{RUN}, DPD_Min, TotalOSPrincipal, Installment Amount Latest, DefaultStatus",
            lookups.format(name="DPD_Min", day="s.min__pt - 1"),
        ),
        "j_lookup_before_last": of(f"{RUN}, DPD_Max", lookups.format(name="DPD_Max", day="s.max__pt - 1")),
        "j_lookup_on_last": of(f"{RUN}, DPD_Max_1", lookups.format(name="DPD_Max_1", day="s.max__pt")),
        "j_area": of(
            f"{RUN}, Provinsi, Kab, Kec, Desa",
            "(SELECT s.*, h.* EXCLUDE (AgreementNo) FROM spans s LEFT JOIN homes h ON h.k = trim(s.agreementno))",
        ),
        "a_run_span": of(RUN, "spans"),
        "a_run_span_by_outcome": of(f"{RUN}, Grouped_Disposition", "blast_spans"),
        "x_calendar": of(
            "pt, messages, month_start, prior_month_end, month_end, today, yesterday, first_day, day_before_first, "
            "last_day, last_day_key",
            f"""(SELECT pt, count(*) AS messages, make_date(year(pt), month(pt), 1) AS month_start,
                        make_date(year(pt), month(pt), 1) - 1 AS prior_month_end, last_day(pt) AS month_end,
                        {at['today']} AS today, {at['yesterday']} AS yesterday, {at['start']} AS first_day,
                        {at['prior_end']} AS day_before_first, {at['month_end']} AS last_day, {at['key']} AS last_day_key
                 FROM activity GROUP BY pt)""",
        ),
        "x_day_shift": of(
            "agreementno, activity_date, day_before, day_after",
            "(SELECT *, pt - 1 AS day_before, pt + 1 AS day_after FROM activity)",
        ),
        "x_yyyymmdd": of(
            "AgreementNo, day_key, day",
            "(SELECT AgreementNo, strftime(ReportDate, '%Y%m%d') AS day_key, ReportDate AS day FROM list)",
        ),
        "x_trim_key": of(
            "activity_date, agreement", "(SELECT activity_date, '[' || trim(agreementno) || ']' AS agreement FROM activity)"
        ),
        "c_sr": of("agreementno, product, angsuran, DPD_Max_1, SR", "outcome"),
        "c_new_sr": of(f"{CONTACT}, newSR", "graced"),
        "c_grouped_disposition": of(
            "agreementno, activity_date, agent_type, disposition, Grouped_Disposition",
            """(SELECT a.*, CASE WHEN r.raw IS NULL THEN 'UNCONTACTED' ELSE 'CONTACTED' END AS Grouped_Disposition
                FROM activity a LEFT JOIN reached r ON r.chan = a.agent_type AND r.raw = a.disposition)""",
        ),
        "c_disposition_new": of(
            "agreementno, activity_date, agent_type, disposition, Disposition_NEW",
            """(SELECT a.*, c.stage AS Disposition_NEW
                FROM activity a LEFT JOIN codes c ON c.chan = a.agent_type AND c.raw = a.disposition)""",
        ),
        "c_report_disposition": of(MEDIA, "media"),
        "w_run_sequence": of("agreementno, product, angsuran, max__pt, rownum", "outcome"),
        "w_contact_dedup": of("agreementno, agent_type, pt", "contacts"),
        "w_contact_sequence": of(
            "agreementno, agent_type, pt, row_number",
            "(SELECT agreementno, agent_type, pt, n AS row_number FROM contact_order)",
        ),
        "d_run_outcome": of(OUTCOME, "outcome"),
        "d_next_day_snapshot": of(NEXT_DAY, "next_day"),
        "d_next_day_contact": of(CONTACT, "contact"),
        "u_three_way_outcome": of(f"{CONTACT}, newSR, branch", "branches"),
        "r_unique_installments": of(f"{CONTACT}, newSR", "branches"),
        "r_unique_agreements": of(f"{CONTACT}, newSR, rn", "agreement_order", "rn = 1"),
        "r_agreement_ranking": of(f"{CONTACT}, newSR, rn", "agreement_order"),
        "d_blast": of(BLAST, "blast"),
        "d_blast_enriched": of(BLAST_OUTCOME, "blast_outcome"),
        "r_blast_best": of(f"{BLAST_OUTCOME}, row_num", "blast_order", "row_num = 1"),
        "r_blast_ranking": of(f"{BLAST_OUTCOME}, row_num", "blast_order"),
        "d_funnel": of(FUNNEL, "funnel"),
        "d_funnel_outcome": of(FUNNEL_OUTCOME, "media"),
        "r_funnel_stages": of(f"{FUNNEL_OUTCOME}, {STAGES}", f"(SELECT *, {_stages()} FROM media)"),
        **best,
        "u_best_per_channel": of(f"{MEDIA}, dispositionwa, rn_wa", "best"),
        "r_channel_report": """
            SELECT product, CAST(angsuran AS BIGINT) AS angsuran, disposition2 AS disposition, agent_type, Provinsi,
                   Desa, Kab, Kec, CAST(count(agreementno) AS BIGINT) AS agreementno, CAST(sum(newSR) AS BIGINT) AS newSR
            FROM best GROUP BY product, angsuran, disposition2, agent_type, Provinsi, Desa, Kab, Kec""",
    }


def statements(as_of: AsOf, tables: str = TABLES, unmapped: str = "FIRST") -> dict[str, str]:
    """Full SQL per query. Tests pass their own definition of the three tables."""
    parts = [part.strip() for part in (tables, CODES, _datasets(as_of, unmapped)) if part.strip()]
    prefix = "WITH " + ",\n".join(parts)
    found = {name: f"{prefix}\n{select}" for name, select in _selects(as_of).items()}
    # Other ways to the same report.
    return found | dict.fromkeys(("r_report_from_state", "r_report_of_messaged"), found["r_channel_report"])
