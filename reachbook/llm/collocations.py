"""Phrase collocations: frequent phrases by how strongly their parts attract.

Which n-grams are frequent is found by Misra-Gries summaries. Each part of the
texts sums up its n-grams per hash partition; the summaries of a partition are
merged into one that has more counters than the partition's mass divided by the
threshold, so what it subtracts stays below the threshold and every frequent
n-gram survives, however many rare ones there are. A second pass over the texts
counts the survivors exactly, by their words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachbook.llm import shards
from reachbook.llm.common import mix, written

UNLABELLED = "und"
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: A-Z in lower case, a tab as a blank, whatever ends a piece as \n.
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _SEPARATORS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(_SEPARATORS)
)
#: Between pieces: a byte that no UTF-8 text holds.
_BREAK = b"\xff"
_GAP = re.compile(rb"[ \n]")
_STRETCH = 1 << 21


@dataclass(frozen=True)
class Rule:
    """Phrases of 2 to `most_words` words that occur `least` times or more; of
    each language the first `top`. A phrase goes if a longer one holds it and has
    `within_percent` of its occurrences. Scores are `scale` times the share. Texts
    are gathered in parts of about `part` bytes; a hash partition has a mass of
    about `mass` n-grams, hence `mass / least` counters."""

    most_words: int = 4
    least: int = 30
    within_percent: int = 80
    scale: int = 2_000_000
    top: int = 2000
    part: int = 1 << 23
    mass: int = 1 << 24


def word_bound(text: bytes) -> int:
    """At most so many words."""
    return len(text) - len(text.translate(None, b" \t" + _SEPARATORS)) + 1


class Words:
    """Numbers of the words of a part; 0 stands between pieces."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[_BREAK]

    def __call__(self, text: bytes) -> list[np.ndarray]:
        """The words of a text, in stretches, a break behind them."""
        text, at, out = text.translate(_PLAIN), 0, []
        while at < len(text):
            gap = _GAP.search(text, min(at + _STRETCH, len(text)))
            end = gap.start() if gap else len(text)
            tokens = text[at:end].replace(b"\n", b" \xff ").split()
            out.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens)))
            at = end
        return [*out, np.zeros(1, np.int64)]


@dataclass
class Level:
    """The distinct n-grams of one size in a text: the number of their first words
    in the level below, their last word, their hash and count."""

    shorter: np.ndarray
    word: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray


def levels_of(numbers: np.ndarray, word_hashes: np.ndarray, most: int) -> Iterator[Level]:
    """Distinct n-grams of 1 to `most` words that cross no break, told apart by their words."""
    n_words = len(word_hashes)
    fresh = numbers != 0
    known, at, counts = np.unique(numbers[fresh], return_inverse=True, return_counts=True)
    hashes = mix(word_hashes[known] + np.uint64(1))
    yield Level(np.empty(0, np.int32), known.astype(np.int32), hashes, counts.astype(np.uint32))
    own = np.zeros(len(numbers), np.int32)
    own[fresh] = at
    for size in range(2, most + 1):
        # An n-gram is one word shorter, and a word more.
        last = numbers[size - 1 :]
        fresh = fresh[: len(last)] & (last != 0)
        pairs = own[: len(last)][fresh].astype(np.int64) * n_words + last[fresh]
        known, at, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        shorter, word = known // n_words, known % n_words
        hashes = mix(hashes[shorter] * np.uint64(0x9E3779B97F4A7C15) + word_hashes[word] + np.uint64(size))
        yield Level(shorter.astype(np.int32), word.astype(np.int32), hashes, counts.astype(np.uint32))
        own = np.zeros(len(last), np.int32)
        own[fresh] = at


@dataclass
class Summary:
    """A Misra-Gries summary: codes in order with their counters, and how much
    has been subtracted from any counter at most. Counters of a merged summary
    never exceed `capacity`."""

    capacity: int
    codes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint32))
    counters: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    taken: int = 0

    def merge(self, others: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Add up summaries, and subtract the first counter too many from all."""
        codes = np.concatenate([self.codes, *(c for c, _ in others)])
        counters = np.concatenate([self.counters, *(n for _, n in others)])
        order = np.argsort(codes, kind="stable")
        codes, counters = codes[order], counters[order]
        starts = _firsts(codes)
        codes = codes[starts]
        counters = np.add.reduceat(counters, starts) if len(starts) else counters
        if len(codes) > self.capacity:
            place = len(codes) - self.capacity - 1
            least = int(np.partition(counters, place)[place])
            left = counters > least
            codes, counters, self.taken = codes[left], counters[left] - least, self.taken + least
        self.codes, self.counters = codes, counters

    def survivors(self, least: int) -> np.ndarray:
        """Codes that may stand for an n-gram with a count of `least`."""
        return self.codes[self.counters + self.taken >= least]


class PartGrams:
    """A part's n-grams: levels per language, and their codes in the order asked.

    A code is the hash partition and 32 bits within it. N-grams that share one
    share its fate, so codes may only keep too many; words tell them apart.
    """

    def __init__(self, part: shards.Part, partitions: int, most: int):
        words, by_label = Words(), {}
        for label, text in zip(part.labels, part.texts(), strict=True):
            by_label.setdefault(label, []).extend(words(text))
        self.names = list(words.numbers)
        del words
        seen = np.fromiter(map(xxhash.xxh3_64_intdigest, self.names), np.uint64, len(self.names))
        self.levels: dict[str, list[Level]] = {}
        for label in sorted(by_label):
            salt = np.uint64(xxhash.xxh3_64_intdigest(label.encode(), 1))
            numbers = np.concatenate(by_label.pop(label))
            self.levels[label] = list(levels_of(numbers, mix(seen ^ salt), most))
            for level in self.levels[label]:
                level.hashes = shards.shard_of(level.hashes, partitions) << np.uint64(32) | level.hashes & np.uint64(0xFFFFFFFF)

    def asked(self) -> np.ndarray:
        """Codes in order, each once."""
        codes = np.sort(np.concatenate([x.hashes for own in self.levels.values() for x in own]))
        return codes[_firsts(codes)]

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes in order, each once, with their counts."""
        codes = np.concatenate([x.hashes for own in self.levels.values() for x in own])
        counts = np.concatenate([x.counts for own in self.levels.values() for x in own])
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order]
        starts = _firsts(codes)
        return codes[starts], np.add.reduceat(counts, starts, dtype=np.int64) if len(starts) else counts

    def kept(self, bits: np.ndarray) -> Iterator[tuple[str, int, Level, np.ndarray]]:
        """Per language and size, the n-grams whose codes have their bit set; bits
        are in the order asked."""
        codes = np.concatenate([x.hashes for own in self.levels.values() for x in own])
        order = np.argsort(codes)
        first = np.zeros(len(codes), np.int32)
        first[_firsts(codes[order])] = 1
        stays = np.empty(len(codes), bool)
        stays[order] = bits[np.cumsum(first) - 1]
        at = 0
        for label, levels in self.levels.items():
            for size, level in enumerate(levels, 1):
                yield label, size, level, np.flatnonzero(stays[at : at + len(level.hashes)])
                at += len(level.hashes)

    def phrases(self, label: str, size: int, chosen: np.ndarray) -> list[bytes]:
        """The words of some n-grams of a size, by their numbers."""
        columns = []
        for level in self.levels[label][size - 1 :: -1]:
            columns.insert(0, [self.names[i] for i in level.word[chosen].tolist()])
            if len(level.shorter):
                chosen = level.shorter[chosen]
        return list(map(b" ".join, zip(*columns, strict=True)))


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Places of values that differ from the one before."""
    if not len(ordered):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([np.ones(1, bool), ordered[1:] != ordered[:-1]]))


_SENT = "shard long, kind int, part long, mass long, codes binary, counts binary"
_NAMES = tuple(c.split()[0] for c in _SENT.split(", "))
_KINDS = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
_TEXTS = ("part", "ids", "labels", "sizes", "packed")


def _by_shard(codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    return shards.runs((codes >> np.uint64(32)).astype(np.int64))


def _low(codes: np.ndarray) -> np.ndarray:
    return (codes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def survivors(parts: DataFrame, partitions: int, rule: Rule) -> DataFrame:
    """(shard, codes): what may be frequent, per hash partition.

    A partition first hears the masses of its summaries, which say how many
    counters it needs, then the summaries, one after another.
    """

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in shards.rows_of(batches):
            part = shards.Part(*row)
            codes, counts = PartGrams(part, partitions, rule.most_words).summed()
            for shard, a, b in _by_shard(codes):
                mass = int(counts[a:b].sum())
                yield shards.one_row(_NAMES, _KINDS, (shard, 0, part.part, mass, None, None))
                packed = shards.pack_numbers(_low(codes[a:b]), True), shards.pack_numbers(counts[a:b].astype(np.uint32))
                yield shards.one_row(_NAMES, _KINDS, (shard, 1, part.part, mass, *packed))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mass, held, waiting = None, 0, Summary(1), []

        def survived() -> pa.RecordBatch:
            held.merge(waiting)
            kept = shards.pack_numbers(held.survivors(rule.least), True)
            return shards.one_row(_NAMES, _KINDS, (at, 0, None, None, kept, None))

        for shard, kind, _, own, codes, counts in shards.rows_of(batches):
            if shard != at:
                if at is not None:
                    yield survived()
                at, mass, held, waiting = shard, 0, Summary(1), []
            if kind == 0:
                mass += own
                held.capacity = mass // rule.least + 1
                continue
            counters = shards.unpack_numbers(counts, np.uint32).astype(np.int64)
            waiting.append((shards.unpack_numbers(codes, np.uint32, True), counters))
            if sum(len(c) for c, _ in waiting) > held.capacity:
                held.merge(waiting)
                waiting = []
        if at is not None:
            yield survived()

    sent = parts.select(*_TEXTS).mapInArrow(summaries, _SENT)
    met = sent.repartition("shard").sortWithinPartitions("shard", "kind")
    return written(met.mapInArrow(merged, _SENT))


def exact_counts(parts: DataFrame, found: DataFrame, partitions: int, rule: Rule) -> DataFrame:
    """(lang, words, phrase, f) of all n-grams that occur `least` times or more,
    and with 0 words and no phrase, how many words each language has.

    Parts ask the hash partitions which of their n-grams survived, get a bit for
    each, and count those that did by their words.
    """

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in shards.rows_of(batches):
            part = shards.Part(*row)
            codes = PartGrams(part, partitions, rule.most_words).asked()
            for shard, a, b in _by_shard(codes):
                yield shards.one_row(_NAMES, _KINDS, (shard, 1, part.part, None, shards.pack_numbers(_low(codes[a:b]), True), None))

    def answering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty(0, np.uint32)
        for shard, kind, part, _, codes, _ in shards.rows_of(batches):
            own = shards.unpack_numbers(codes, np.uint32, True)
            if kind == 0:
                kept = own
                continue
            there = np.minimum(np.searchsorted(kept, own), max(len(kept) - 1, 0))
            bits = kept[there] == own if len(kept) else np.zeros(len(own), bool)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            values = (part, shard, len(own), np.packbits(bits).tobytes())
            yield shards.one_row(("part", "shard", "asked", "kept"), types, values)

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: list[np.ndarray] = []
        for kind, part, asked, kept, *rest in shards.rows_of(batches):
            if kind == 0:
                bits.append(np.unpackbits(np.frombuffer(kept, np.uint8), count=asked).astype(bool))
                continue
            yield from _phrases(PartGrams(shards.Part(part, *rest), partitions, rule.most_words), bits)
            bits = []

    asked = parts.select(*_TEXTS).mapInArrow(asking, _SENT)
    met = found.unionAll(asked).repartition("shard").sortWithinPartitions("shard", "kind")
    answers = met.mapInArrow(answering, "part long, shard long, asked long, kept binary")
    texts = parts.select(F.lit(1).alias("kind"), *_TEXTS)
    both = answers.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    both = both.select("kind", "part", "shard", "asked", "kept", "ids", "labels", "sizes", "packed")
    both = both.repartition("part").sortWithinPartitions("part", "kind", "shard").drop("shard")
    counted = both.mapInArrow(counting, "lang string, words int, phrase string, f long")
    summed = counted.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    return written(summed.where((F.col("words") == 0) | (F.col("f") >= rule.least)))


def _phrases(part: PartGrams, bits: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for label, levels in part.levels.items():
        yield _counted(label, 0, [None], np.array([levels[0].counts.sum()]))
    for label, size, level, chosen in part.kept(np.concatenate([np.empty(0, bool), *bits])):
        for start in range(0, len(chosen), 10_000):
            own = chosen[start : start + 10_000]
            yield _counted(label, size, part.phrases(label, size, own), level.counts[own])


def _counted(label: str, size: int, phrases: list[bytes | None], counts: np.ndarray) -> pa.RecordBatch:
    n = len(phrases)
    phrase = pa.array(phrases, pa.binary()).cast(pa.string())
    columns = [pa.array([label] * n, pa.string()), pa.array([size] * n, pa.int32()), phrase, pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["lang", "words", "phrase", "f"])


def _slice(first: Column, size: Column) -> Column:
    """Words of a phrase, from the first of them on."""
    return F.concat_ws(" ", F.slice(F.split("phrase", " "), first, size))


def scored(counts: DataFrame, rule: Rule) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of all phrases, by their lowest cut.
    Products are decimals, so they are exact whatever the counts."""
    f, wide = counts.where("words > 0"), "decimal(38,0)"
    phrases = f.where("words > 1").withColumnRenamed("f", "a")
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "*", _slice(F.lit(1), F.col("k")).alias("head"), _slice(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail")
    )
    heads = f.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = f.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    share = F.expr(f"(cast({rule.scale} as {wide}) * a) div (cast(l as {wide}) + r)")
    lowest = F.min(F.struct(share.alias("score"), "k", "l", "r")).alias("cut")
    each = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    return each.groupBy("lang", "phrase", "words", "a").agg(lowest).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score")
    )


def within_longer(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): how often the most frequent longer phrase occurs that holds it."""
    places = F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> struct(i, n))))")
    inner = counts.where("words > 2").withColumn("at", F.explode(places))
    inner = inner.select("lang", _slice(F.col("at.i"), F.col("at.n")).alias("inner"), "f")
    return inner.groupBy("lang", F.col("inner").alias("phrase")).agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame, *, rule: Rule = Rule(), text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The first phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are in lower case (A-Z), cut into pieces at `.,;:!?` and line ends, and
    those into words at blanks and tabs. Occurrences overlap and never cross
    pieces. Null languages are `und`, null texts empty; repeated rows count as
    often as they are there; ties go by occurrences, then by the phrase's bytes.
    Very long texts are taken whole; other columns are ignored; no rows, or no
    phrase that is frequent, give no rows.
    """
    each = docs.select(
        F.lit(None).alias("id"),
        F.coalesce(F.col(lang).cast("string"), F.lit(UNLABELLED)).alias("label"),
        F.col(text).alias("text"),
    )
    parts = shards.gathered(each, lambda t: rule.most_words * word_bound(t), rule.part)
    partitions = shards.shards_for(parts, rule.mass)
    counts = exact_counts(parts, survivors(parts, partitions, rule), partitions, rule)
    wide = "decimal(38,0)"
    inside = F.expr(f"cast(100 as {wide}) * longer >= cast({rule.within_percent} as {wide}) * a")
    left = scored(counts, rule).join(within_longer(counts), ["lang", "phrase"], "left")
    left = left.where(~F.coalesce(inside, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= rule.top)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
