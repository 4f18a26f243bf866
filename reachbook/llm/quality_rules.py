"""Quality rules with compression bands.

Text that compresses far better than prose repeats itself; text that hardly
compresses at all is encoded or random. Both are told by the zstandard ratio of
the whole document and of its fixed chunks, against limits that depend on the
length, since short texts always compress less. Lengths count symbols, not bytes
of UTF-8: the same prose has the same ratio in letters of one, two or three bytes.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.llm.common import SPACE, in_batches, per_text

SYMBOLS = b"#*$%&|<>"


# First length in symbols of each band, and least and most ratio there,
# as `fit_bands` finds them in the documents of sf0.1 (a test repeats it).
STARTS = (0, 256, 362, 512, 724, 1024, 1448, 2048, 2896, 4096, 5793, 8192, 11585, 16384, 23170)
LIMITS = (
    (0.0, 2.07), (1.2, 2.07), (1.26, 2.2), (1.31, 2.39), (1.43, 2.49), (1.55, 2.62), (1.63, 2.77), (1.7, 2.85),
    (1.75, 2.96), (1.81, 3.04), (1.87, 3.12), (1.91, 3.22), (1.96, 3.33), (2.02, 3.36), (2.02, 4.37),
)


@dataclass(frozen=True)
class Bands:
    """`starts[i]` is the first length in symbols to which `limits[i]`, (least,
    most) ratio, applies. A text is rejected if it lies outside its limits, or
    more than `bad_share` of its symbols are in chunks outside theirs. The limits
    come from a reference corpus by `fit_bands`. Texts that are mostly Han
    characters, kana or Hangul have `wide` limits of their own, by hand: no prose
    in them was at hand, and as each character says much, only repetition shows."""

    starts: tuple[int, ...] = STARTS
    limits: tuple[tuple[float, float], ...] = LIMITS
    wide: tuple[float, float] = (1.0, 5.0)
    chunk: int = 4096
    bad_share: float = 0.5
    level: int = 3

    def outside(self, size: int, ratio: float, wide: bool = False) -> bool:
        low, high = self.wide if wide else self.limits[bisect_right(self.starts, size) - 1]
        return not low <= ratio <= high


#: Code points that stand for several letters: kana for two, Han characters and
#: Hangul and Yi syllables for three.
_KANA = (0x3041, 0x30FF)
_WIDE = ((0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xAC00, 0xD7A3), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
#: Bytes that encode those, which no letter gets while a text has some.
_WIDE_BYTES = frozenset(range(0x80, 0xC0)) | frozenset(range(0xE0, 0xF8))
#: Bytes in the order in which letters get them: those of Latin letters first, so
#: that other alphabets look the same to the compressor.
_BYTES = (*range(97, 123), *range(65, 91), *range(192, 256), *range(128, 192), *range(0, 65), *range(91, 97), *range(123, 128))
_STRETCH = 1 << 20


def symbols(data: bytes) -> bytes:
    """A UTF-8 text with one byte per letter of whatever alphabet.

    ASCII stays as it is. Every other code point gets a byte that the text does
    not use, the most frequent ones first; should there be too few, the rest stay
    in UTF-8. Kana become two bytes; Han characters, Hangul and Yi syllables keep
    their UTF-8, as each says about as much as that many letters.
    """
    if data.isascii():
        return data
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    known, times = np.unique(points, return_counts=True)
    codes = [chr(p).encode() for p in known.tolist()]
    kana = (known >= _KANA[0]) & (known <= _KANA[1])
    wide = kana.copy()
    for low, high in _WIDE:
        wide |= (known >= low) & (known <= high)
    for i in np.flatnonzero(kana).tolist():
        codes[i] = codes[i][1:]
    used = set(known[known < 128].tolist()) | (_WIDE_BYTES if wide.any() else set())
    narrow = np.flatnonzero((known >= 128) & ~wide)
    narrow = narrow[np.argsort(-times[narrow], kind="stable")].tolist()
    for i, byte in zip(narrow, (b for b in _BYTES if b not in used), strict=False):
        codes[i] = bytes((byte,))
    sizes = np.array([len(c) for c in codes])
    table = np.frombuffer(b"".join(c.ljust(4, b"\0") for c in codes), np.uint8).reshape(-1, 4)
    out = []
    for start in range(0, len(points), _STRETCH):
        at = np.searchsorted(known, points[start : start + _STRETCH])
        out.append(table[at][np.arange(4) < sizes[at, None]].tobytes())
    return b"".join(out)


def mostly_wide(data: bytes) -> bool:
    """Whether more than half of a text's ink is Han characters, kana, Hangul or Yi."""
    if data.isascii():
        return False
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    wide = (points >= _KANA[0]) & (points <= _KANA[1])
    for low, high in _WIDE:
        wide |= (points >= low) & (points <= high)
    return 2 * int(np.count_nonzero(wide)) > int(np.count_nonzero(points > 32))


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a UTF-8 text."""
    words = data.split()
    ink = data.translate(None, SPACE)
    # Continuation bytes of UTF-8 start no code point.
    chars = len(ink) - int(np.count_nonzero((np.frombuffer(ink, np.uint8) & 0xC0) == 0x80))
    symbols = len(ink) - len(ink.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    repeated = 0
    for line in data.split(b"\n"):
        if line.strip():
            repeated += line in seen
            seen.add(line)
    return len(words), chars, symbols, repeated, _repeat_words(words)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) >= 1 << 20:  # three factors would overflow: number the pairs first
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(known) + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(windows) + 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = twice.copy()
    inside[1:] |= twice[:-1]
    inside[2:] |= twice[:-2]
    return int(inside.sum())


class Judge:
    """The compression verdict; one compressor for many texts."""

    def __init__(self, bands: Bands):
        self.bands = bands
        self.compressor = zstandard.ZstdCompressor(level=bands.level)

    def ratio(self, data: bytes) -> float:
        return len(data) / len(self.compressor.compress(data)) if data else 0.0

    def __call__(self, data: bytes) -> tuple[float, float, bool]:
        """Ratio of a UTF-8 text, share of symbols in bad chunks, and whether it stays."""
        wide = mostly_wide(data)
        data = symbols(data)
        bands, whole = self.bands, self.ratio(data)
        if len(data) <= bands.chunk:
            outside = bands.outside(len(data), whole, wide)
            return whole, float(outside and bool(data)), not outside
        bad = 0
        for start in range(0, len(data), bands.chunk):
            chunk = data[start : start + bands.chunk]
            bad += len(chunk) * bands.outside(len(chunk), self.ratio(chunk), wide)
        share = bad / len(data)
        return whole, share, not bands.outside(len(data), whole, wide) and share <= bands.bad_share


@dataclass(frozen=True)
class Verdict:
    counts: tuple[int, int, int, int, int]
    base_failed: bool
    kept: bool
    ratio: float
    bad_share: float


def judge_text(text: str, judge: Judge, min_words: int = 50) -> Verdict:
    """Base rules and compression bands on one text."""
    data = text.encode()
    counts = base_counts(data)
    failed = counts[0] < min_words or 100 * counts[4] > 50 * counts[0]
    ratio, share, fits = judge(data)
    return Verdict(counts, failed, fits and not failed, ratio, share)


def quality_rules(
    docs: DataFrame, *, bands: Bands = Bands(), min_words: int = 50, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document with its counts, compression figures and verdict.

    A document fails the base rules with fewer than `min_words` words, or with
    more than half of them in repeated 3-word windows. Null and empty texts have
    no words, so they fail. Repeated rows are judged alike, a very long text is
    compressed chunk by chunk, other columns are ignored, no rows give no rows.
    """
    columns = dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), pa.int64())
    columns |= {"base_failed": pa.bool_(), "kept": pa.bool_(), "ratio": pa.float64(), "bad_share": pa.float64()}
    held: list[Judge] = []

    def step(value: str) -> tuple:
        if not held:
            held.append(Judge(bands))
        found = judge_text(value, held[0], min_words)
        return (*found.counts, found.base_failed, found.kept, found.ratio, found.bad_share)

    return per_text(docs, key, text, columns, step)


def fit_bands(
    docs: DataFrame, *, tail: float = 0.005, margins: tuple[float, float] = (0.12, 0.2), least: int = 30,
    per_octave: int = 2, min_words: int = 50, plan: Bands = Bands(), text: str = "text",
) -> Bands:
    """Limits from a reference corpus: per band of lengths, `per_octave` of them
    for each doubling, all but a `tail` of the ratios on either side, and a margin
    beyond that.

    Whole texts that pass the base rules count, and full chunks of longer ones;
    wide scripts do not. Bands with fewer than `least` ratios share the limits of
    the next shorter one, the longest with a third more above. Limits
    never fall with the length. Spark's percentile sketches do the counting; the
    driver sees one row per band. Without a reference the limits stay as they are.
    """
    held: list[Judge] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not held:
            held.append(Judge(plan))
        bands, ratios = [], []
        for value in batch.column(0).to_pylist():
            data = (value or "").encode()
            counts = base_counts(data)
            if counts[0] < min_words or 100 * counts[4] > 50 * counts[0] or mostly_wide(data):
                continue
            data = symbols(data)
            pieces = [data] + [data[i : i + plan.chunk] for i in range(0, len(data) - plan.chunk, plan.chunk)]
            bands += [int(np.floor(np.log2(len(x)) * per_octave)) for x in pieces]
            ratios += [held[0].ratio(x) for x in pieces]
        return pa.RecordBatch.from_arrays([pa.array(bands, pa.int32()), pa.array(ratios, pa.float64())], ["band", "ratio"])

    each = in_batches(docs.select(F.col(text).cast("string").alias("text")), step, "band int, ratio double")
    found = each.groupBy("band").agg(F.count("*").alias("n"), F.percentile_approx("ratio", [tail, 1 - tail], 10_000).alias("ends"))
    rows = sorted((r["band"], *r["ends"]) for r in found.where(F.col("n") >= least).collect())
    if not rows:
        return plan
    lows = np.minimum.accumulate([r[1] * (1 - margins[0]) for r in rows][::-1])[::-1]
    highs = np.maximum.accumulate([r[2] * (1 + margins[1]) for r in rows])
    starts = [0, *[round(2 ** (r[0] / per_octave)) for r in rows], round(2 ** ((rows[-1][0] + 1) / per_octave))]
    limits = [(0.0, highs[0]), *zip(lows, highs, strict=True), (lows[-1], highs[-1] * 1.3)]
    return replace(plan, starts=tuple(starts), limits=tuple((round(float(a), 2), round(float(b), 2)) for a, b in limits))
