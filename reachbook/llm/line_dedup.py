"""Removal of lines that many documents share, by sharded minimal perfect hashes.

Lines are counted by a 96-bit hash of what they say: 64 bits are its place, 32
its print. Each shard, a range of places, turns its distinct lines into a minimal
perfect hash: a few bits per line that give every line its own number, under
which two plain arrays hold its print and in how many documents it is. Documents
look their lines up in those arrays; no line is ever joined with a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.llm import shards
from reachbook.llm.common import SPACE, mix, written

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """Lines whose key, stripped and in lower case, has `min_chars` code points or
    more and is in `min_docs` documents or more go. Texts are asked for in parts
    of about `part` bytes; a shard has about `shard` lines. A perfect hash spends
    `gamma` bits on each line it has to place: more are faster, fewer smaller."""

    min_chars: int = 1
    min_docs: int = 10
    part: int = 1 << 24
    shard: int = 1 << 19
    gamma: float = 1.5

    @property
    def counts(self) -> type:
        """Counts stop at the most that their type holds, which is enough to tell."""
        return np.uint8 if self.min_docs < 256 else np.uint32


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line of a UTF-8 text."""
    return [line.strip(SPACE) for line in text.translate(_LOWER).split(b"\n")]


def long_enough(key: bytes, least: int) -> bool:
    if len(key) < least:
        return False
    # Up to four bytes a code point: only then do they have to be counted.
    return len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least


def hashed(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Place and print of each key."""
    data = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2).astype(np.uint64)
    return data[:, 0], data[:, 1].astype(np.uint32)


def summed(places: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each line once, in order of place and print, with the sum of its counts."""
    if not len(places):
        return places, prints, counts
    order = np.lexsort((prints, places))
    places, prints = places[order], prints[order]
    first = np.ones(len(places), bool)
    first[1:] = (places[1:] != places[:-1]) | (prints[1:] != prints[:-1])
    starts = np.flatnonzero(first)
    return places[starts], prints[starts], np.add.reduceat(counts[order], starts)


class PerfectHash:
    """A number of its own, 0 to n - 1, for each of n distinct lines.

    Level by level, the lines left are dealt to places of a bit array; those that
    have a place alone set its bit, the others go on. A line's number is how many
    bits are set before its own. A line that was not placed gets any number or -1.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.starts: list[np.ndarray] = []
        before = 0
        for level in levels:
            each = np.bitwise_count(level).astype(np.int64)
            self.starts.append(before + np.cumsum(each) - each)
            before += int(each.sum())
        self.size = before

    @classmethod
    def of(cls, places: np.ndarray, prints: np.ndarray, gamma: float) -> PerfectHash:
        levels = []
        while len(places):
            size = -(-int(len(places) * gamma + 1) // 64) * 64
            dealt = cls._dealt(places, prints, len(levels), size)
            alone = np.bincount(dealt, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = ~alone[dealt]
            places, prints = places[left], prints[left]
        return cls(levels)

    @staticmethod
    def _dealt(places: np.ndarray, prints: np.ndarray, level: int, size: int) -> np.ndarray:
        turned = mix(places + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        turned = mix(turned ^ prints.astype(np.uint64))
        return ((turned >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)

    def __call__(self, places: np.ndarray, prints: np.ndarray) -> np.ndarray:
        out = np.full(len(places), -1, np.int64)
        open_ = np.arange(len(places))
        for number, (level, starts) in enumerate(zip(self.levels, self.starts, strict=True)):
            at = self._dealt(places[open_], prints[open_], number, len(level) * 64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            there = level[word] >> bit & np.uint64(1) == 1
            before = level[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[there]] = (starts[word] + np.bitwise_count(before))[there]
            open_ = open_[~there]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.levels), *[len(x) for x in self.levels]], np.int64)
        return head.tobytes() + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, 8).tolist()
        at, levels = 8 * (n + 1), []
        for size in sizes:
            levels.append(np.frombuffer(data, np.uint64, size, at))
            at += 8 * size
        return cls(levels)


@dataclass
class Lines:
    """A shard's lines: their perfect hash, and under their numbers print and count."""

    perfect: PerfectHash
    prints: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, places: np.ndarray, prints: np.ndarray, counts: np.ndarray, rule: Rule) -> Lines:
        perfect = PerfectHash.of(places, prints, rule.gamma)
        number = perfect(places, prints)
        own_prints, own_counts = np.empty(len(places), np.uint32), np.empty(len(places), rule.counts)
        own_prints[number] = prints
        own_counts[number] = np.minimum(counts, np.iinfo(rule.counts).max)
        return cls(perfect, own_prints, own_counts)

    def __call__(self, places: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """In how many documents each line is, 0 for one that was never counted."""
        number = self.perfect(places, prints)
        known = number >= 0
        known[known] = self.prints[number[known]] == prints[known]
        out = np.zeros(len(places), self.counts.dtype)
        out[known] = self.counts[number[known]]
        return out


_ASKED = "shard long, kind int, part long, places binary, prints binary, counts binary"
_NAMES = tuple(c.split()[0] for c in _ASKED.split(", "))
_KINDS = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[shards.Part]:
    for row in shards.rows_of(batches):
        yield shards.Part(*row)


def _asked(parts: DataFrame, count: int, rule: Rule) -> DataFrame:
    """Per part and shard: its lines in order, and in how many of its documents each is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _texts(batches):
            found = [
                hashed([k for k in set(line_keys(text)) if long_enough(k, rule.min_chars)]) for text in part.texts()
            ]
            places, prints = (np.concatenate(c) for c in zip(*found, strict=True))
            places, prints, times = summed(places, prints, np.ones(len(places), np.uint32))
            for shard, a, b in shards.runs(shards.shard_of(places, count)):
                packed = shards.pack_numbers(places[a:b], True), prints[a:b].tobytes(), shards.pack_numbers(times[a:b].astype(np.uint32))
                yield shards.one_row(_NAMES, _KINDS, (shard, 1, part.part, *packed))

    return written(parts.select("part", "ids", "labels", "sizes", "packed").mapInArrow(run, _ASKED))


def _lines(places: bytes, prints: bytes) -> tuple[np.ndarray, np.ndarray]:
    return shards.unpack_numbers(places, np.uint64, True), np.frombuffer(prints, np.uint32)


def line_index(asked: DataFrame, rule: Rule) -> DataFrame:
    """One row per shard: its perfect hash, prints and counts.

    A line is in a row of each part that has it, so no line is hot; rows of a
    shard are summed up before they are twice as many as its lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, fresh = None, [], 0

        def merged() -> tuple:
            return summed(*(np.concatenate(c) for c in zip(*held, strict=True)))

        def indexed() -> pa.RecordBatch:
            lines = Lines.of(*merged(), rule)
            values = (at, 0, None, lines.perfect.dump(), lines.prints.tobytes(), lines.counts.tobytes())
            return shards.one_row(_NAMES, _KINDS, values)

        for shard, _, _, places, prints, counts in shards.rows_of(batches):
            if held and shard != at:
                yield indexed()
                held, fresh = [], 0
            at = shard
            held.append((*_lines(places, prints), shards.unpack_numbers(counts, np.uint32).astype(np.int64)))
            fresh += len(held[-1][0])
            if fresh > max(len(held[0][0]), rule.shard):
                held, fresh = [merged()], 0
        if held:
            yield indexed()

    by_shard = asked.repartition("shard").sortWithinPartitions("shard")
    return written(by_shard.mapInArrow(run, _ASKED))


def _answered(asked: DataFrame, index: DataFrame, rule: Rule) -> DataFrame:
    """(part, shard, gone): one bit per line asked, whether it goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: Lines | None = None
        for shard, kind, part, places, prints, counts in shards.rows_of(batches):
            if kind == 0:
                held = np.frombuffer(prints, np.uint32), np.frombuffer(counts, rule.counts)
                lines = Lines(PerfectHash.load(places), *held)
                continue
            gone = lines(*_lines(places, prints)) >= rule.min_docs
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            values = (part, shard, len(gone), np.packbits(gone).tobytes())
            yield shards.one_row(("part", "shard", "asked", "gone"), types, values)

    met = index.unionAll(asked).repartition("shard").sortWithinPartitions("shard", "kind")
    return met.mapInArrow(run, "part long, shard long, asked long, gone binary")


def line_dedup(docs: DataFrame, *, rule: Rule = Rule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: n_lines, n_dropped, and the text that is left, `kept`.

    Lines are what lies between \\n. A line's key is the line without blanks at
    its ends, A-Z in lower case. Each row is a document: a row that is repeated
    counts as often as it is there, ids may be null or shared. A null or empty
    text is one empty line. A text that loses all its lines is empty. Very long
    texts are taken whole; other columns are ignored; no rows give no rows.
    """
    each = docs.select(F.col(key).alias("id"), F.lit(None).alias("label"), F.col(text).alias("text"))
    parts = shards.gathered(each, lambda t: t.count(b"\n") + 1, rule.part)
    asked = _asked(parts, shards.shards_for(parts, rule.shard), rule)
    answers = _answered(asked, line_index(asked, rule), rule)
    names, types = (key, "n_lines", "n_dropped", "kept"), (pa.int64(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: list[np.ndarray] = []
        for kind, part, asked, gone, *rest in shards.rows_of(batches):
            if kind == 0:
                bits.append(np.unpackbits(np.frombuffer(gone, np.uint8), count=asked).astype(bool))
                continue
            yield from _rewritten(shards.Part(part, *rest), bits, names, types, rule)
            bits = []

    texts = parts.select(F.lit(1).alias("kind"), "part", "ids", "labels", "sizes", "packed")
    both = answers.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    met = both.select("kind", "part", "shard", "asked", "gone", "ids", "labels", "sizes", "packed")
    met = met.repartition("part").sortWithinPartitions("part", "kind", "shard").drop("shard")
    return met.mapInArrow(run, f"`{key}` long, n_lines long, n_dropped long, kept string")


def _rewritten(part: shards.Part, bits: list[np.ndarray], names, types, rule: Rule) -> Iterator[pa.RecordBatch]:
    """The texts of a part without the lines that go. Its lines are hashed and put
    in order once more, as they were when it asked."""
    known = list({k for text in part.texts() for k in set(line_keys(text)) if long_enough(k, rule.min_chars)})
    places, prints = hashed(known)
    gone = np.concatenate(bits)[np.argsort(np.lexsort((prints, places)))] if bits else np.empty(0, bool)
    bad = {known[i] for i in np.flatnonzero(gone).tolist()}
    rows: list[tuple] = []
    size = 0
    for one, text in zip(part.ids, part.texts(), strict=True):
        lines = left = text.split(b"\n")
        if bad:
            left = [line for line, k in zip(lines, line_keys(text), strict=True) if k not in bad]
        rows.append((one, len(lines), len(lines) - len(left), b"\n".join(left)))
        size += len(rows[-1][3])
        if size >= 1 << 21 or len(rows) >= 1000:
            yield _batch(rows, names, types)
            rows, size = [], 0
    if rows:
        yield _batch(rows, names, types)


def _batch(rows: list[tuple], names, types) -> pa.RecordBatch:
    *columns, texts = zip(*rows, strict=True)
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.binary()).cast(pa.string())], list(names))
