"""Secret scans: fixed patterns, and name-literal pairs read from source and
configuration syntax."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from reachbook.llm.common import per_text
from reachbook.llm.spans import Span, digest, joined

#: Kinds in their listed order; the lexer's own kind comes last.
KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
# A run that is too short stays too short from any later start in it.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_OPERATOR = re.compile(r":=|=>|[:=]")
_NAME_END = re.compile(r"[A-Za-z0-9_.\-]")
#: A quoted literal, whatever prefix its language puts before it: b"", rb'', u8"", @"", r#""#.
_QUOTED = re.compile(
    r"""(?:[A-Za-z]{1,2}|u8R?|[@$]{1,2})?(?:"\""((?:[^"\\]|\\.|"{1,2}(?!"))*)"\""|'''((?:[^'\\]|\\.|'{1,2}(?!'))*)'''"""
    r"""|"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)|b?r(\#+)"([^"]*)"\6""",
    re.DOTALL,
)
_BARE = re.compile(r"""[^\s,;&"'`{}()\[\]<>]+""")
#: Names inside a longer literal without quotes are part of it, unless all pairs are asked for.
_LONGEST_BARE = 1000
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")
_BLANK = " \t"
#: What a type may hold outside brackets, and words in it that are no type of their own.
_TYPE = re.compile(r"[A-Za-z0-9_.&*?|!$\-'\" \t]")
_MODIFIERS = frozenset(("mut", "const", "dyn", "readonly", "unsigned", "signed", "final"))
#: Types that stand between a name and `=` without a colon, and words that announce such a name.
_PLAIN_TYPES = frozenset(("string", "str", "text", "char", "nchar", "varchar", "varchar2", "nvarchar", "bytes"))
_DECLARES = frozenset(("var", "const", "declare", "let"))
_BRACKET = re.compile(r"[()\[\]{}<>\n;]")
_CLOSES = {"]": "[", ")": "(", ">": "<", "}": "{"}
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: How many characters each kind has. Signs that join words do not make a literal mixed.
_KINDS_OF_CHARACTERS = (
    (26, re.compile(r"[a-z]")), (26, re.compile(r"[A-Z]")), (10, re.compile(r"[0-9]")), (32, re.compile(r"[^A-Za-z0-9_.\-/:\s]")),
)


@dataclass(frozen=True)
class Scoring:
    """Weight of each word of a target name, and the least score of a secret.

    The score is the sum of the name's weights times the literal's strength:
    bits of information per character times length, 0 to 1, full at `full_bits`.
    """

    weights: tuple[tuple[str, float], ...] = (
        ("password", 1.0), ("passwd", 1.0), ("pwd", 1.0), ("passphrase", 1.0), ("secret", 1.0), ("token", 0.8),
        ("apikey", 1.0), ("credential", 0.9), ("credentials", 0.9), ("auth", 0.5), ("bearer", 0.7), ("private", 0.5),
        ("access", 0.4), ("api", 0.4), ("key", 0.5), ("signing", 0.4), ("encryption", 0.4), ("salt", 0.4),
    )
    harmless: tuple[str, ...] = ("count", "length", "limit", "max", "min", "type", "name", "file", "path", "url", "id")
    placeholders: tuple[str, ...] = ("changeme", "example", "placeholder", "redacted", "none", "null", "true", "false")
    least: float = 0.6
    min_chars: int = 8
    full_bits: float = 48.0


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each fixed pattern."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def assignments(text: str, longest: int | None = _LONGEST_BARE) -> list[tuple[str, int, int]]:
    """Name-literal pairs in order: the target name, where its literal lies.

    Understands `name = "literal"`, `name: literal`, `"name": "literal"`,
    `name := ...` and `name => ...`; declared types (`name: str = ...`, `var name
    string = ...`, `Dim name As String = ...`, `char name[] = ...`); subscripts
    (`table["name"] = ...`); and prefixed or triple quotes. A name that is later
    assigned to another stands for its literal there, so that pair points to the
    literal as well. A literal without quotes ends at a blank, a bracket, a quote,
    `,`, `;` or `&`, and names inside it have what follows them there; if it has
    more than `longest` characters, they are left out (None: never). Every
    character is read a bounded number of times.
    """
    constants: dict[str, tuple[int, int]] = {}
    pairs = []
    openings = _openings(text)
    run = (0, 0)  # the literal without quotes that was read last
    for operator in _OPERATOR.finditer(text):
        if longest is not None and run[0] <= operator.start() < run[1] and run[1] - run[0] > longest:
            continue
        names = _names_before(text, operator.start(), operator.group() == "=", openings)
        if not names:
            continue
        at = operator.end()
        while at < len(text) and text[at] in _BLANK:
            at += 1
        if quoted := _QUOTED.match(text, at):
            where = quoted.span(quoted.lastindex)
        elif at < len(text) and (run[0] <= at < run[1] or (bare := _BARE.match(text, at))):
            # What follows an operator inside a literal ends where that does.
            run = (at, run[1]) if run[0] <= at < run[1] else bare.span()
            where = run
            if (known := _IDENTIFIER.fullmatch(text, *where)) and known.group() in constants:
                where = constants[known.group()]
        else:
            continue
        if where[1] > where[0]:
            for name in names:
                constants[name] = where
                pairs.append((name, *where))
    return pairs


def _back_over_blanks(text: str, at: int) -> int:
    while at and text[at - 1] in _BLANK:
        at -= 1
    return at


def _names_before(text: str, end: int, declares: bool, openings: dict[int, int]) -> list[str]:
    """The names that an operator assigns to: the one right before it, or the one
    that a type or a subscript before it belongs to."""
    at = _back_over_blanks(text, end)
    names = [_subscripted(text, at, openings) if at and text[at - 1] == "]" else _name_before(text, at)]
    if declares:
        names += [_annotated(text, at, openings), _declared(text, at, openings)]
    return list(dict.fromkeys(n for n in names if n))


def _name_before(text: str, end: int) -> str:
    """The name that ends before an operator, without quotes and blanks."""
    at = _back_over_blanks(text, end)
    if at and text[at - 1] in "\"'`":
        at -= 1
    start = at
    while start and _NAME_END.match(text[start - 1]):
        start -= 1
    name = text[start:at]
    return name if name and not name[0].isdigit() else ""


def _openings(text: str) -> dict[int, int]:
    """Where each closed bracket opens, by where it closes; both on one line."""
    found: dict[int, int] = {}
    held: list[tuple[str, int]] = []
    for mark in _BRACKET.finditer(text):
        char, at = mark.group(), mark.start()
        if char in "\n;":
            held.clear()
        elif char in _CLOSES:
            while char != ">" and held and held[-1][0] == "<":
                held.pop()  # less than
            if held and held[-1][0] == _CLOSES[char]:
                found[at] = held.pop()[1]
        else:
            held.append((char, at))
    return found


def _subscripted(text: str, end: int, openings: dict[int, int]) -> str:
    """The table's name and its keys, joined by dots: `a["b"]["c"]` is a.b.c, `a[0]` is a."""
    keys: list[str] = []
    at = end
    while at and text[at - 1] == "]":
        start = openings.get(at - 1, -1)
        if start < 0:
            return ""
        key = text[start + 1 : at - 1].strip(" \t:\"'`")
        if key and not key.isdigit():
            keys.insert(0, key)
        at = _back_over_blanks(text, start)
    return ".".join(n for n in (_name_before(text, at), *keys) if n)


def _annotated(text: str, end: int, openings: dict[int, int]) -> str:
    """The name before a colon and a type: `name: dict[str, str] | None`."""
    at, kept = end, ""
    while at:
        char = text[at - 1]
        if char in "])>":
            at = openings.get(at - 1, 0)
        elif char == ":" and text[at - 2 : at - 1] != ":":
            words = [w.split() for w in kept[::-1].replace("&", " ").replace("*", " ").split("|")]
            plain = [[x for x in own if x not in _MODIFIERS and (x[0] != "'" or x[-1] == "'")] for own in words]
            before = at - 1
            while before and text[before - 1] in "?! \t":
                before -= 1
            return _name_before(text, before) if all(len(own) <= 1 for own in plain) else ""
        elif char == ":":
            kept += "."
            at -= 2
        elif _TYPE.match(char):
            kept += char
            at -= 1
        else:
            return ""
    return ""


def _declared(text: str, end: int, openings: dict[int, int]) -> str:
    """The name before a type without a colon: `var name string`, `name varchar(20)`,
    `name As String`."""
    if end and text[end - 1] in "])":
        end = _back_over_blanks(text, openings.get(end - 1, 0))
    kind = _name_before(text, end)
    at = _back_over_blanks(text, end - len(kind))
    name = _name_before(text, at) if kind and at < end - len(kind) else ""
    rest = _back_over_blanks(text, at - len(name))
    if not name or text[at - 1] in "\"'`":
        return ""
    if name.lower() == "as":
        return _name_before(text, rest) if rest < at - len(name) else ""
    announced = rest < at - len(name) and _name_before(text, rest).lower() in _DECLARES
    return name if announced or kind.lower() in _PLAIN_TYPES else ""


def sensitivity(name: str, scoring: Scoring) -> float:
    """Sum of the weights of a name's words; 0 if its last word is harmless."""
    words = [w.lower() for w in _WORD.findall(name)]
    weights = dict(scoring.weights)
    if not words or words[-1] in scoring.harmless:
        return 0.0
    joint = {a + b for a, b in zip(words, words[1:], strict=False)}
    return sum(weights.get(w, 0.0) for w in {*words, *joint})


def strength(literal: str, scoring: Scoring) -> float:
    """0 to 1: bits of information in the literal; 0 for short ones, single
    plain words and placeholders.

    Characters that come from three kinds or more (lower case, upper case, digits,
    signs) are not those of words: there each different one has the bits of its
    kinds, so the shortest mixed literal can be full too.
    """
    low = literal.lower()
    if len(literal) < scoring.min_chars or literal.isalpha() or any(p in low for p in scoring.placeholders):
        return 0.0
    n = len(literal)
    counts = Counter(literal)
    bits = -sum(c * math.log2(c / n) for c in counts.values())
    sizes = [size for size, found in _KINDS_OF_CHARACTERS if found.search(literal)]
    if len(sizes) >= 3:
        bits = max(bits, len(counts) * math.log2(sum(sizes)))
    return min(1.0, bits / scoring.full_bits)


def strengths(text: str, starts: list[int], end: int, scoring: Scoring) -> dict[int, float]:
    """`strength` of literals that end at one place, by where they start.

    From the shortest on: a longer one holds what the one before it holds, so it
    has its placeholders and at least its bits. Names and operators between the
    starts bring bits, so few are read whole before one is full; of those after it
    only what is new is read.
    """
    longest = max((len(p) for p in scoring.placeholders), default=0)
    found: dict[int, float] = {}
    value, last, void = 0.0, end, False
    for start in sorted(starts, reverse=True):
        if not void:
            new = text[start : min(end, last + longest)].lower()
            void = any(p in new for p in scoring.placeholders)
        if void:
            value = 0.0
        elif value < 1.0:
            value = strength(text[start:end], scoring)
        found[start] = value
        last = start
    return found


def literal_spans(text: str, scoring: Scoring, taken: list[Span]) -> list[Span]:
    """Literals of sensitive names, each once, that no fixed pattern covers whole."""
    weights: dict[int, dict[int, float]] = {}  # by end, then by start
    for name, start, end in assignments(text, longest=None):
        weight = sensitivity(name, scoring)
        if weight:
            own = weights.setdefault(end, {})
            own[start] = max(own.get(start, 0.0), min(weight, 1.0))
    spans = []
    for end, own in weights.items():
        strong = strengths(text, list(own), end, scoring)
        spans += [(start, end) for start, weight in own.items() if weight * strong[start] >= scoring.least]
    spans.sort()
    # Spans of one kind never overlap, so the last one that starts no later is
    # the only one of its kind that can cover a literal.
    kinds: dict[str, list[Span]] = {}
    for span in taken:
        kinds.setdefault(span[0], []).append(span)
    starts = {kind: [s[1] for s in own] for kind, own in kinds.items()}

    def free(start: int, end: int) -> bool:
        before = ((own, bisect_right(starts[kind], start)) for kind, own in kinds.items())
        return not any(i and own[i - 1][2] >= end for own, i in before)

    return [("literal", s, e) for s, e in spans if free(s, e)]


def find_secrets(text: str, scoring: Scoring = Scoring()) -> tuple[list[Span], list[Span]]:
    """The fixed patterns' spans, and those that the lexer adds."""
    base = base_spans(text)
    added = literal_spans(text, scoring, base) if ":" in text or "=" in text else []
    return base, added


def by_start(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_scan(docs: DataFrame, *, scoring: Scoring = Scoring(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts by kind, digest of the base spans, all spans.

    Offsets are code points, ends exclusive. Null and empty texts have no spans;
    repeated rows get the same ones; texts are scanned whole however long they
    are; other columns are ignored; no rows give no rows.
    """
    columns = dict.fromkeys(("n_assign", "n_access", "n_hex"), pa.int64())
    columns |= {"base_sha256": pa.string(), "spans": pa.string(), "n_literal": pa.int64()}

    def step(value: str) -> tuple:
        base, added = find_secrets(value, scoring)
        counts = Counter(s[0] for s in base)
        ordered = by_start(base)
        every = by_start(base + added) if added else ordered
        return (*(counts[k] for k in KINDS[:3]), digest(ordered), joined(every), len(added))

    return per_text(docs, key, text, columns, step)


def redact(text: str, scoring: Scoring = Scoring(), mask: str = "[SECRET]") -> str:
    """The text with every secret replaced; overlapping spans become one mask."""
    base, added = find_secrets(text, scoring)
    parts, at = [], 0
    for _, start, end in by_start(base + added):
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if parts else text
