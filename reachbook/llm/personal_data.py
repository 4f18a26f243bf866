"""Personal data: fixed patterns, and spans that a trained tagger adds.

A character tagger (bidirectional LSTM with CRF transitions) is trained on
windows labelled by the patterns, and on made-up data in forms that no pattern
has: national phone numbers, mail addresses that are spelled out, numbers with
other separators. It reads overlapping windows; their scores are averaged where
they overlap and one best path over all of them decides. Every kind of span holds
a digit, an `@` or `at` in brackets, so text without them needs no window.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.llm.common import in_batches
from reachbook.llm.spans import Span, digest, joined
from reachbook.llm.tagger import Path, Shape, Tagger, codes

KINDS = ("email", "ip", "card", "phone")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TRIGGER = re.compile(r"[0-9@]|(?<=[(\[{])(?:at|AT)(?=[)\]}])")
#: Tags: 0 outside, then for each kind its first character and its others.
TAGS = 1 + 2 * len(KINDS)


@dataclass(frozen=True)
class Training:
    """Windows of `width` characters, one every `stride`. At most `sample_docs`
    documents, those whose id hashes lowest, and `sample_windows` windows of
    theirs train the tagger, with `made` windows into which made-up data is
    written."""

    width: int = 96
    stride: int = 48
    sample_docs: int = 3000
    sample_windows: int = 1500
    made: int = 8000
    steps: int = 700
    batch: int = 64
    rate: float = 0.01
    seed: int = 5


def digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(number: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(number)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping matches. The part before the `@` is looked for
    from each `@` on, so runs without one cost nothing."""
    at, low = text.find("@"), 0
    while at >= 0:
        start = at
        while start > low and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        match = _EMAIL.match(text, start) if start < at else None
        if match and match.end() > at:
            yield match.span()
            low = match.end()
        at = text.find("@", max(at + 1, low))


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches by kind, without those that fail."""
    found = [("email", *span) for span in emails(text)]
    if not _DIGIT.search(text):
        return found
    if "." in text:
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(_part(p) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            number = digits(m.group())
            if 16 <= len(number) <= 19 and luhn(number):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]
    return found


def _part(text: str) -> bool:
    number = text.lstrip("0")
    return len(number) <= 3 and int(number or 0) <= 255


def by_kind(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def window_starts(text: str, plan: Training) -> list[int]:
    """Starts of the windows whose characters hold a digit or an `@`, in order."""
    wanted: dict[int, None] = {}
    for m in _TRIGGER.finditer(text):
        last = m.start() // plan.stride
        for number in range(max(0, last - plan.width // plan.stride + 1), last + 1):
            wanted[number * plan.stride] = None
    return sorted(wanted)


def _tags(length: int, spans: list[Span]) -> np.ndarray:
    """Tags of a text; where kinds overlap the one listed first holds."""
    tags = np.zeros(length, np.int8)
    for kind, start, end in sorted(spans, key=lambda s: -KINDS.index(s[0])):
        first = 1 + 2 * KINDS.index(kind)
        tags[start:end] = first + 1
        tags[start] = first
    return tags


# Training.


def _sampled(docs: DataFrame, plan: Training) -> list[tuple[str, bytes]]:
    """Windows of text and their tags from the sampled documents."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        windows, tags = [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            starts = window_starts(text, plan)
            if starts:
                own = _tags(len(text), base_spans(text))
                for start in starts:
                    windows.append(text[start : start + plan.width])
                    tags.append(own[start : start + plan.width].tobytes())
        if not windows:
            return None
        return pa.RecordBatch.from_arrays([pa.array(windows), pa.array(tags, pa.binary())], ["window", "tags"])

    ids = docs.select("id").where("id is not null").orderBy(F.xxhash64("id"), "id").limit(plan.sample_docs)
    last = ids.agg(F.max(F.xxhash64("id"))).first()[0]
    if last is None:
        return []
    chosen = docs.where(F.xxhash64("id") <= F.lit(last)).select("id", "text")
    found = in_batches(chosen, step, "window string, tags binary")
    # Windows with spans first: the others are many and alike.
    plain = (F.regexp_replace(F.hex("tags"), "0", "") == "").cast("int")
    rows = found.orderBy(F.pmod(F.xxhash64("window"), F.lit(1 << 20)) + plain * (1 << 19), "window", "tags")
    return [(r["window"], bytes(r["tags"])) for r in rows.limit(plan.sample_windows).collect()]


def _some(rng: np.random.Generator, n: int, chars: str = "0123456789") -> str:
    return "".join(chars[i] for i in rng.integers(0, len(chars), n))


def _one(rng: np.random.Generator, *choices: str) -> str:
    return choices[int(rng.integers(0, len(choices)))]


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _email(rng: np.random.Generator, plain: bool) -> str:
    user = _some(rng, rng.integers(3, 9), _LETTERS) + _one(rng, "", ".", "_", "+", "-")
    user += _some(rng, rng.integers(1, 7), _LETTERS + "0123456789")
    host = [_some(rng, rng.integers(3, 10), _LETTERS), *_one(rng, "com", "org", "net", "example.org", "de", "fr").split(".")]
    if plain:
        return user + "@" + ".".join(host)
    at, dot = _one(rng, " @ |.", " (at) |.", " [at] |.", "(at)|.", "[at]|.", " (at) | (dot) ", " [at] | [dot] ", "[at]|[dot]", "{at}|.").split("|")
    return user + at + dot.join(host)


def _ip(rng: np.random.Generator, plain: bool) -> str:
    dot = "." if plain else _one(rng, "[.]", "(.)", "[dot]")
    return dot.join(str(x) for x in rng.integers(0, 256, 4))


def _card(rng: np.random.Generator, plain: bool) -> str:
    body = _some(rng, 15)
    number = next(body + str(d) for d in range(10) if luhn(body + str(d)))
    sep = _one(rng, "", " ", "-") if plain else _one(rng, ".", "  ", " - ", "_")
    return sep.join(number[i : i + 4] for i in range(0, 16, 4))


def _phone(rng: np.random.Generator, plain: bool) -> str:
    sep = _one(rng, " ", "-", ".")
    area, three, four = _one(rng, *"23456789") + _some(rng, 2), _one(rng, *"23456789") + _some(rng, 2), _some(rng, 4)
    if plain:
        area = f"({area})" if rng.random() < 0.5 else area
        return f"+{rng.integers(1, 99)} {area}{sep}{three}{_one(rng, sep, '')}{four}"
    form = int(rng.integers(0, 5))
    if form == 0:
        return f"({area}) {three}{_one(rng, '-', ' ', '.')}{four}"
    if form == 1:
        return f"{area}{sep}{three}{sep}{four}"
    if form == 2:
        return f"00{rng.integers(10, 99)} {area}{sep}{three}{sep}{four}"
    if form == 3:
        return f"0{_one(rng, *'123456789')}{_some(rng, int(rng.integers(1, 4)))}{_one(rng, ' ', '/', '-', ' / ')}{_some(rng, int(rng.integers(6, 9)))}"
    return "0" + " ".join([_one(rng, *"1234567"), *(_some(rng, 2) for _ in range(4))])


_FORMS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone}


def _made(rng: np.random.Generator, kind: str) -> str:
    """Made-up data of a kind, in the forms the patterns know and in others."""
    return _FORMS[kind](rng, rng.random() < 0.6)


def _harmless(rng: np.random.Generator) -> str:
    """Numbers and signs that are no personal data."""

    def some(n: int, chars: str = "0123456789") -> str:
        return _some(rng, n, chars)

    forms = (
        lambda: f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}",
        lambda: f"{rng.integers(1, 29):02d}{(sep := _one(rng, '.', '/', '-'))}{rng.integers(1, 13):02d}{sep}{rng.integers(1900, 2100)}",
        lambda: f"{rng.integers(1900, 2100)}{_one(rng, '-', ' - ', '/')}{rng.integers(1900, 2100)}",
        lambda: f"{rng.integers(0, 20)}.{rng.integers(0, 20)}",
        lambda: f"{rng.integers(0, 9)}.{rng.integers(0, 30)}.{rng.integers(0, 30)}",
        lambda: f"{rng.integers(0, 9)}.{rng.integers(0, 30)}.{rng.integers(0, 30)}.{rng.integers(300, 9999)}",
        lambda: some(int(rng.integers(1, 8))),
        lambda: some(int(rng.integers(8, 20))),
        lambda: some(int(rng.integers(16, 41)), "0123456789abcdef"),
        lambda: some(int(rng.integers(16, 41)), "0123456789ABCDEF"),
        lambda: "-".join(some(n, "0123456789abcdef") for n in (8, 4, 4, 4, 12)),
        lambda: f"{rng.integers(1, 999)},{some(3)}.{some(2)}",
        lambda: f"{rng.integers(1, 999)}{(sep := _one(rng, ' ', ',', '.'))}{some(3)}{sep}{some(3)}",
        lambda: "AKIA" + some(16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
        lambda: f"{rng.integers(0, 24)}:{some(2)}:{some(2)}",
        lambda: f"{_one(rng, '978', '979')}-{some(1)}-{some(2)}-{some(6)}-{some(1)}",
        lambda: f"{rng.integers(1, 200)}, {rng.integers(1, 200)}, {rng.integers(1, 200)}",
        lambda: f"({rng.integers(1, 200)}) {rng.integers(1, 200)}",
        lambda: f"{_one(rng, *'ABCXYZ')}{_one(rng, *'ABCXYZ')}-{some(int(rng.integers(3, 7)))}",
        lambda: "@" + some(5, "abcdefghijklmnop"),
        lambda: f"{some(4, _LETTERS)} ({_one(rng, 'at', 'in', 'by')}) {some(5, _LETTERS)} {some(4, _LETTERS)}",
    )
    return forms[int(rng.integers(0, len(forms)))]()


def examples(sampled: list[tuple[str, bytes]], plan: Training) -> tuple[np.ndarray, np.ndarray]:
    """Windows (N, width) of character classes and their tags."""
    rng = np.random.default_rng(plan.seed)
    hosts = [w for w, t in sampled if not any(t)] or ["the of and to in is that for it was on are as with by at " * 3]
    every = list(sampled)
    for number in range(plan.made):
        host = hosts[int(rng.integers(0, len(hosts)))]
        host = _TRIGGER.sub("x", host)
        at = int(rng.integers(0, max(1, len(host) - 24)))
        kind = number % (len(KINDS) + 3)  # three of seven are harmless
        piece = _made(rng, KINDS[kind]) if kind < len(KINDS) else _harmless(rng)
        lead = str(rng.choice([" ", " ", ": ", "\n", ""]))
        before = host[:at].rstrip() + (lead if lead or at == 0 else " ")
        text = (before + piece + str(rng.choice([" ", ".", ", ", "\n"])) + host[at:])[: plan.width]
        spans = [(KINDS[kind], len(before), min(len(before) + len(piece), len(text)))] if kind < len(KINDS) else []
        every.append((text, _tags(len(text), [s for s in spans if s[1] < s[2]]).tobytes()))
    windows = np.zeros((len(every), plan.width), np.uint8)
    tags = np.zeros((len(every), plan.width), np.int64)
    for row, (text, own) in enumerate(every):
        values = codes(text)[: plan.width]
        windows[row, : len(values)] = values
        tags[row, : len(values)] = np.frombuffer(own, np.int8)[: plan.width]
    return windows, tags


def train(docs: DataFrame, plan: Training = Training()) -> Tagger:
    """A tagger fitted to a bounded sample of (id, text)."""
    windows, tags = examples(_sampled(docs, plan), plan)
    tagger = Tagger(Shape(TAGS))
    tagger.fit(windows, tags, steps=plan.steps, batch=plan.batch, rate=plan.rate)
    return tagger


# Reading.


def stretches(starts: list[int], plan: Training) -> Iterator[list[int]]:
    """Windows that follow or overlap each other, together."""
    group: list[int] = []
    for start in starts:
        if group and start > group[-1] + plan.stride:
            yield group
            group = []
        group.append(start)
    if group:
        yield group


def tagged_spans(texts: list[str], tagger: Tagger, plan: Training, windows_at_once: int = 512) -> list[list[Span]]:
    """Spans that the tagger finds in each text."""
    found: list[list[Span]] = [[] for _ in texts]
    batch: list[tuple[int, np.ndarray, list[int]]] = []
    held = 0
    for number, text in enumerate(texts):
        starts = window_starts(text, plan)
        if not starts:
            continue
        values = codes(text)
        for group in stretches(starts, plan):
            if len(group) > windows_at_once:
                found[number] += _read_long(values, group, tagger, plan, windows_at_once)
                continue
            batch.append((number, values, group))
            held += len(group)
            if held >= windows_at_once:
                _decode(batch, tagger, plan, found)
                batch, held = [], 0
    _decode(batch, tagger, plan, found)
    return found


def _scored(values: np.ndarray, group: list[int], tagger: Tagger, plan: Training) -> np.ndarray:
    windows = np.zeros((len(group), plan.width), np.uint8)
    for row, start in enumerate(group):
        own = values[start : start + plan.width]
        windows[row, : len(own)] = own
    return tagger.emissions(windows)


def _read_long(values: np.ndarray, group: list[int], tagger: Tagger, plan: Training, at_once: int) -> list[Span]:
    """Spans of a long stretch, some windows after the other: scores are averaged
    and let go as soon as no later window reads their characters."""
    path = Path(tagger)
    begin, last = group[0], min(group[-1] + plan.width, len(values))
    total, times = np.zeros((0, TAGS), np.float32), np.zeros((0, 1), np.float32)
    tags, at = [], begin
    for low in range(0, len(group), at_once):
        own = group[low : low + at_once]
        until = min(own[-1] + plan.width, last)
        more = until - at - len(total)
        total = np.concatenate([total, np.zeros((more, TAGS), np.float32)])
        times = np.concatenate([times, np.zeros((more, 1), np.float32)])
        for start, scores in zip(own, _scored(values, own, tagger, plan), strict=True):
            size = min(plan.width, len(values) - start)
            total[start - at : start - at + size] += scores[:size]
            times[start - at : start - at + size] += 1
        done = (group[low + at_once] if low + at_once < len(group) else last) - at
        tags.append(path.feed(total[:done] / np.maximum(times[:done], 1)))
        total, times, at = total[done:], times[done:], at + done
    return _read(np.concatenate([*tags, path.finish()]), begin)


#: Characters of lines that are decoded together, with what fills the shorter ones.
_PADDED = 1 << 16


def _together(lines: list[tuple[int, int, np.ndarray]]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Lines of about one length, up to 64 and no more than so many characters."""
    some: list[tuple[int, int, np.ndarray]] = []
    for line in sorted(lines, key=lambda x: len(x[2])):
        if some and (len(some) == 64 or (len(some) + 1) * len(line[2]) > _PADDED):
            yield some
            some = []
        some.append(line)
    if some:
        yield some


def _decode(batch, tagger: Tagger, plan: Training, found: list[list[Span]]) -> None:
    lines = []
    for number, values, group in batch:
        begin, end = group[0], min(group[-1] + plan.width, len(values))
        lines.append((number, begin, np.zeros((end - begin, TAGS), np.float32), np.zeros((end - begin, 1), np.float32)))
    places = [(line, start) for line, (_, _, group) in enumerate(batch) for start in group]
    for low in range(0, len(places), 512):
        some = places[low : low + 512]
        windows = np.zeros((len(some), plan.width), np.uint8)
        for row, (line, start) in enumerate(some):
            own = batch[line][1][start : start + plan.width]
            windows[row, : len(own)] = own
        for (line, start), scores in zip(some, tagger.emissions(windows), strict=True):
            _, begin, total, times = lines[line]
            size = min(plan.width, len(batch[line][1]) - start)
            total[start - begin : start - begin + size] += scores[:size]
            times[start - begin : start - begin + size] += 1
    for some in _together([(number, begin, total / np.maximum(times, 1)) for number, begin, total, times in lines]):
        lengths = np.array([len(x[2]) for x in some])
        padded = np.zeros((len(some), lengths.max(), TAGS), np.float32)
        for row, (_, _, own) in enumerate(some):
            padded[row, : len(own)] = own
        for (number, begin, _), tags, length in zip(some, tagger.best_paths(padded, lengths), lengths, strict=True):
            found[number] += _read(tags[:length], begin)


def _read(tags: np.ndarray, begin: int) -> list[Span]:
    """Spans of a path of tags: from a first character over its others."""
    turns = np.flatnonzero(np.diff(tags, prepend=0))
    spans, start, kind = [], -1, -1
    for at in [*turns.tolist(), len(tags)]:
        tag = int(tags[at]) if at < len(tags) else 0
        if start >= 0 and tag != 2 * kind + 2:
            spans.append((KINDS[kind], begin + start, begin + at))
            start = -1
        if tag % 2:
            start, kind = at, tag // 2
    return spans


_AT = re.compile(r"@|[(\[{](?:at|AT)[)\]}]")


def plausible(text: str, span: Span) -> bool:
    """Whether a found span has as many digits, or letters round an `at`, as any of
    its kind. How it is written is for the path to say."""
    kind, start, end = span
    own = text[start:end]
    if own != own.strip() or "\n" in own:
        return False
    count = len(digits(own))
    if kind == "email":
        user, *rest = _AT.split(own)
        return len(rest) == 1 and bool(re.search(r"[A-Za-z0-9]", user)) and bool(re.search(r"[A-Za-z0-9].*[A-Za-z]{2,}$", rest[0]))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", own)
        return len(parts) == 4 and all(_part(p) for p in parts)
    if kind == "card":
        return 16 <= count <= 19 and luhn(digits(own))
    return 8 <= count <= 15


def _apart(added: list[Span], base: list[Span]) -> list[Span]:
    """Added spans that touch no other."""
    taken = sorted((s, e) for _, s, e in base)
    kept = []
    starts = np.array([s for s, _ in taken])
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else np.empty(0, int)
    for span in sorted(added, key=lambda s: s[1]):
        at = int(np.searchsorted(starts, span[2])) - 1
        if at >= 0 and reach[at] > span[1]:
            continue
        if not kept or kept[-1][2] <= span[1]:
            kept.append(span)
    return kept


def personal_data(docs: DataFrame, *, plan: Training = Training(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts by kind, digest of the base spans, all spans.

    Offsets are code points, ends exclusive. Null and empty texts have no spans;
    repeated rows get the same ones; every window of a very long text that can
    hold a span is read; other columns are ignored; no rows give no rows. The
    sample and the seeds are fixed, so reruns agree.
    """
    each = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    tagger = train(each, plan)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        rows = []
        for value, more in zip(texts, tagged_spans(texts, tagger, plan), strict=True):
            base = base_spans(value)
            added = _apart([s for s in more if plausible(value, s)], base) if more else []
            counts = Counter(s[0] for s in base)
            ordered = by_kind(base)
            rows.append((*(counts[k] for k in KINDS), digest(ordered), joined(by_kind(base + added)), len(added)))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        names = [key, *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return in_batches(each, step, f"{key} long, {counts}, base_sha256 string, spans string, n_added long")
