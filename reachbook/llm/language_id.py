"""Language identification by character language models.

Each language has an interpolated Kneser-Ney model over letters, learned from
the n-gram counts of all its labelled documents. Counts, continuation counts,
discounts and probabilities are tables that Spark aggregates and joins, so they
grow with the corpus and no process holds them. Texts are gathered in parts; a
part's n-grams meet their scores by ranges of their hashes. A text has the
language whose model needs the fewest bits per symbol for it; how far the next
one lies behind says how sure that is, on a scale fitted to all labelled documents.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachbook.llm import shards
from reachbook.llm.common import Scratch, mix, stored

#: Symbols are code points: 0 between words, 1 to 26 for a to z, all other letters and marks as they are.
BITS = 21
#: A long takes three symbols, so an n-gram is two: the last three, and those before.
LOW = 3
UNDECIDED = "und"


@dataclass(frozen=True)
class Plan:
    """Models over n-grams of `order` symbols, 2 to 6. Texts are gathered in parts
    of about `part` characters, fewer if those have more than about `grams` different
    n-grams; about `buffer` n-grams are held before they are summed up, and a range
    of hashes has about `bucket` n-grams. So many `languages` are scored at once;
    more take their turns."""

    order: int = 5
    #: Not read any more: confidence is fitted to all labelled documents.
    fit_rows: int | None = None
    buffer: int = 1 << 20
    part: int = 1 << 25
    grams: int = 1 << 21
    bucket: int = 1 << 18
    languages: int = 16


class Alphabet:
    """Symbols of texts: lower-cased letters, one 0 for all else between them."""

    def __init__(self) -> None:
        points = np.arange(0x110000, dtype=np.uint32)
        letters = np.fromiter((unicodedata.category(chr(p))[0] in "LM" for p in range(len(points))), bool, len(points))
        self.table = np.where(letters, points, 0).astype(np.uint32)
        self.table[ord("a") : ord("z") + 1] = np.arange(1, 27)

    def __call__(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.collapsed(self.table[points])

    @staticmethod
    def collapsed(symbols: np.ndarray) -> np.ndarray:
        symbols = np.concatenate([np.zeros(1, np.uint32), symbols, np.zeros(1, np.uint32)])
        keep = np.ones(len(symbols), bool)
        keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
        return symbols[keep]


def _packed(padded: np.ndarray, first: int, last: int, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for i in range(first, last):
        out = out << BITS | padded[i : size + i]
    return out


def wide_grams(symbols: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text's symbols in two numbers: what lies before the last three, and those."""
    if len(symbols) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    padded = np.concatenate([np.zeros(order - 2, np.uint32), symbols]).astype(np.int64)
    size = len(padded) - order + 1
    cut = max(order - LOW, 0)
    return _packed(padded, 0, cut, size), _packed(padded, cut, order, size)


def wide_hash(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(mix(high.astype(np.uint64) + np.uint64(1)) + low.astype(np.uint64))


@dataclass
class Learned:
    languages: list[str]
    slope: float = 1.0
    offset: float = 0.0
    #: Most bits per symbol of a text that is taken to be in its language.
    most_bits: dict[str, float] = field(default_factory=dict)


_PARTS = "kind int, part long, label string, ids array<long>, labels array<string>, sizes array<long>, packed binary"


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Hashes, both numbers and counts of n-grams, each once, in the order of the hashes."""
    hashes, high, low, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate([np.ones(1, bool), hashes[1:] != hashes[:-1]]))
    return hashes[first], high[order[first]], low[order[first]], np.add.reduceat(n[order], first)


def _parts(each: DataFrame, plan: Plan, scratch: Scratch) -> DataFrame:
    """Texts in parts, their symbols packed (kind 0), and each part's n-grams with
    their counts by label (kind 1; no label: not learned from). Texts are stored
    once, in buckets of parts, and never shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, packer = Alphabet(), zstandard.ZstdCompressor(level=6)
        draw = np.random.default_rng()
        rows: list[tuple] = []
        texts, written = packer.compressobj(), []
        held: dict[str | None, tuple[np.ndarray, ...]] = {}
        waiting: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}

        def settle() -> int:
            for label in list(waiting):
                high, low = (np.concatenate(c) for c in zip(*waiting.pop(label), strict=True))
                if len(high):
                    new = _merged([(wide_hash(high, low), high, low, np.ones(len(high), np.int64))])
                    held[label] = _merged([held.pop(label), new]) if label in held else new
            return sum(len(found[0]) for found in held.values())

        def finished() -> Iterator[pa.RecordBatch]:
            nonlocal texts
            part = int(draw.integers(1 << 62))
            settle()
            written.append(texts.flush())  # a compressor packs one thing at a time
            for label in list(held):
                found = held.pop(label)
                order = np.lexsort((found[2], found[1]))
                own = packer.compressobj(size=3 * 8 * len(order))
                data = b"".join([*[own.compress(c[order].data) for c in found[1:]], own.flush()])
                yield _part(1, part, label, None, None, [len(order)], data)
            ids, labels, sizes = (list(c) for c in zip(*rows, strict=True))
            data = b"".join(written)
            texts = packer.compressobj()
            rows.clear(), written.clear()
            yield _part(0, part, None, ids, labels, sizes, data)

        size = fresh = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for one, text, label in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                    text = text or ""
                    found = alphabet(text)
                    high, low = wide_grams(found, plan.order)
                    waiting.setdefault(label, []).append((high, low))
                    data = found.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
                    written.append(texts.compress(data))
                    rows.append((one, label, len(data)))
                    size += len(text) + 1
                    fresh += len(high)
                    full = size >= plan.part
                    if fresh >= plan.buffer:
                        fresh, full = 0, settle() >= plan.grams or full
                    if full:
                        yield from finished()
                        size = fresh = 0
        if rows:
            yield from finished()

    found = each.select("id", "text", "label").mapInArrow(run, _PARTS)
    return scratch.bucketed(found, "part", int(each.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _part(kind, part, label, ids, labels, sizes, packed) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
    values = (kind, part, label, ids, labels, sizes, packed)
    names = [c.split()[0] for c in _PARTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)


def _unpacked(packed: bytes, size: int) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int64)
    return [data[i * size : (i + 1) * size] for i in range(3)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(batch.num_rows):
            yield tuple(c[0] for c in (x.to_pylist() for x in batch.slice(start, 1).columns))


def _counts(parts: DataFrame) -> DataFrame:
    """(label, high, low, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, sizes, packed in _rows(batches):
            found = _unpacked(packed, sizes[0])
            for start in range(0, sizes[0], 1 << 16):
                piece = [pa.array(x[start : start + (1 << 16)]) for x in found]
                labels = pa.array([label] * len(piece[0]), pa.string())
                yield pa.RecordBatch.from_arrays([labels, *piece], ["label", "high", "low", "n"])

    found = parts.where("kind = 1").select("label", "sizes", "packed")
    return found.mapInArrow(run, "label string, high long, low long, n long").groupBy("label", "high", "low").agg(F.sum("n").alias("n"))


def _suffix(size: int) -> list[Column]:
    """The last `size` symbols of an n-gram."""
    high = F.col("high").bitwiseAND(F.lit((1 << BITS * max(size - LOW, 0)) - 1))
    return [high.alias("high"), F.col("low").bitwiseAND(F.lit((1 << BITS * min(size, LOW)) - 1)).alias("low")]


def _context() -> list[Column]:
    """All symbols of an n-gram but the last."""
    moved = F.shiftleft(F.col("high").bitwiseAND(F.lit((1 << BITS) - 1)), BITS * (LOW - 1))
    return [F.shiftright("high", BITS).alias("c_high"), F.shiftright("low", BITS).bitwiseOR(moved).alias("c_low")]


def learn(counts: DataFrame, order: int, scratch: Scratch) -> list[tuple[DataFrame, DataFrame]]:
    """Per size from 1 to `order`: (label, high, low, p) of all n-grams seen, and
    (label, c_high, c_low, spared) of their contexts, the share left to unseen ones."""
    levels = [counts]
    for size in range(order - 1, 0, -1):
        # A shorter n-gram counts once per symbol seen before it.
        shorter = levels[0].select("label", *_suffix(size)).groupBy("label", "high", "low")
        levels.insert(0, scratch.written(shorter.agg(F.count("*").alias("n"))))
    tables: list[tuple[DataFrame, DataFrame]] = []
    for size, own in enumerate(levels, 1):
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discount = own.groupBy("label").agg(F.when(ones > 0, ones / (ones + 2 * twos)).otherwise(0.5).alias("discount"))
        own = own.select("*", *_context())
        context = own.groupBy("label", "c_high", "c_low").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        context = context.join(discount, "label").withColumn("spared", F.col("discount") * F.col("kinds") / F.col("total"))
        context = scratch.written(context)
        found = own.join(context, ["label", "c_high", "c_low"])
        if size == 1:
            lower = F.lit(1.0 / (1 << BITS))
        else:
            below = tables[-1][0].select("label", F.col("high").alias("s_high"), F.col("low").alias("s_low"), F.col("p").alias("lower"))
            high, low = _suffix(size - 1)
            found = found.select("*", high.alias("s_high"), low.alias("s_low")).join(below, ["label", "s_high", "s_low"])
            lower = F.col("lower")
        p = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("spared") * lower
        found = scratch.written(found.select("label", "high", "low", p.alias("p")))
        tables.append((found, context.select("label", "c_high", "c_low", "spared")))
    return tables


def score_grams(wanted: DataFrame, tables: list[tuple[DataFrame, DataFrame]], languages: list[str]) -> DataFrame:
    """(high, low, logs): log2 probability of the last symbol of each wanted n-gram
    after the others, by language."""

    def by_gram(table: DataFrame, names: list[str], value: str, out: str) -> DataFrame:
        entry = F.struct("label", F.log2(value).alias("log"))
        return table.groupBy(*names).agg(F.map_from_entries(F.collect_list(entry)).alias(out))

    order = len(tables)
    names = F.array(*[F.lit(x) for x in languages])
    lower = None
    for size, (found, context) in enumerate(tables, 1):
        own = wanted if size == order else wanted.select(*_suffix(size)).distinct()
        own = own.select("high", "low", *_context())
        own = own.join(by_gram(found, ["high", "low"], "p", "seen"), ["high", "low"], "left")
        own = own.join(by_gram(context, ["c_high", "c_low"], "spared", "known"), ["c_high", "c_low"], "left")
        if lower is None:
            own = own.withColumn("lower", F.array_repeat(F.lit(-float(BITS)), len(languages)))
        else:
            high, low = _suffix(size - 1)
            below = lower.select(F.col("high").alias("s_high"), F.col("low").alias("s_low"), F.col("logs").alias("lower"))
            own = own.select("*", high.alias("s_high"), low.alias("s_low")).join(below, ["s_high", "s_low"])

        def one(name: Column, rest: Column) -> Column:
            # Unseen after a known context: what that leaves, times the shorter n-gram.
            return F.coalesce(F.col("seen")[name], F.coalesce(F.col("known")[name], F.lit(0.0)) + rest)

        lower = own.select("high", "low", F.zip_with(names, F.col("lower"), one).alias("logs"))
    return lower


def _calibrate(learned: Learned, scores: DataFrame, scratch: Scratch) -> None:
    """Fit the confidence, and the most bits a text of each language needs, to all
    labelled documents; equal ones are counted."""
    names = F.array(*[F.lit(x) for x in learned.languages])
    train = scores.where("lang is not null and best >= 0")
    right = (F.get(names, F.col("best")) == F.col("lang")).cast("double").alias("right")
    rows = scratch.written(train.groupBy("best", right, "margin", "bits").agg(F.count("*").alias("n")))
    learned.slope, learned.offset = _fit(rows)
    learned.most_bits = {learned.languages[best]: 1.25 * bits for best, bits in _quantiles(rows, 0.99).items()}


def _fit(rows: DataFrame) -> tuple[float, float]:
    """Slope and offset of a logistic regression of `right` on `margin`, by
    Newton's method: from what margins in small steps lead to, with the margins as
    they are."""
    near = rows.groupBy("right", F.round(F.col("margin") * 256).alias("step")).agg(F.sum("n").alias("n")).collect()
    near = sorted((r["step"] / 256, r["right"], r["n"]) for r in near)
    # One example of each outcome at no margin, and one right one at a wide margin, keep it finite.
    held = np.array([(0.0, 0.0, 1.0), (0.0, 1.0, 1.0), (5.0, 1.0, 1.0)])

    def here(of: np.ndarray, a: float, b: float) -> np.ndarray:
        x, y, n = of.T
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = n * (p * (1 - p) + 1e-9)
        return np.array([(n * (p - y) * x).sum(), (n * (p - y)).sum(), (w * x * x).sum(), (w * x).sum(), w.sum()])

    def everywhere(a: float, b: float) -> np.ndarray:
        x, n = F.col("margin"), F.col("n")
        p = 1 / (1 + F.exp(-F.greatest(F.least(a * x + b, F.lit(30.0)), F.lit(-30.0))))
        off, w = n * (p - F.col("right")), n * (p * (1 - p) + 1e-9)
        # Sums of decimals do not depend on how texts were gathered.
        sums = [F.sum(v.cast("decimal(28,12)")).cast("double") for v in (off * x, off, w * x * x, w * x, w)]
        return np.array([v or 0.0 for v in rows.agg(*sums).first()]) + here(held, a, b)

    a, b = 1.0, 0.0
    for sums in (lambda a, b: here(np.array([*held.tolist(), *near]), a, b), everywhere):
        for _ in range(50):
            x, one, xx, x1, ones = sums(a, b)
            step = np.linalg.solve([[xx + 1e-2, x1], [x1, ones]], [x + 1e-2 * a, one + 1e-2 * b])
            step = np.clip(step, -1, 1)
            a, b = a - float(step[0]), b - float(step[1])
            if np.abs(step).max() < 1e-9:
                break
    return max(a, 1e-3), b


def _quantiles(rows: DataFrame, share: float) -> dict[int, float]:
    """By language, the bits that this share of the texts rightly taken for it
    need at most, between the two nearest: the bin of each is found from counts,
    and its place among the different values of that bin."""
    own = rows.where("right = 1").groupBy("best", "bits").agg(F.sum("n").alias("n"))
    own = own.withColumn("bin", F.floor(F.col("bits") * 64))
    language, last = Window.partitionBy("best"), F.ceil("place")
    bins = own.groupBy("best", "bin").agg(F.sum("n").alias("held"))
    bins = bins.withColumn("before", F.sum("held").over(language.orderBy("bin")) - F.col("held"))
    bins = bins.withColumn("place", (F.sum("held").over(language) - 1) * F.lit(share))
    bins = bins.where((F.col("before") <= last) & (F.col("before") + F.col("held") > F.floor("place")))
    inside = own.join(bins, ["best", "bin"])
    until = F.col("before") + F.sum("n").over(Window.partitionBy("best", "bin").orderBy("bits"))
    inside = inside.withColumn("until", until).where((F.col("until") - F.col("n") <= last) & (F.col("until") > F.floor("place")))
    found: dict[int, float] = {}
    for r in inside.select("best", "bits", "place").orderBy("best", "bits").collect():
        low = found.get(r["best"], r["bits"])
        found[r["best"]] = low + (r["bits"] - low) * (r["place"] % 1)
    return found


#: Logarithms travel as 16-bit numbers in steps of 1/256 bit: off by 1/512 at
#: most, and no symbol costs more than 128 bits.
STEPS = 256
_MET = "kind int, bucket long, part long, hashes binary, logs binary"
_NAMES = tuple(c.split()[0] for c in _MET.split(", "))
_KINDS = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
_FOUND = "id long, lang string, part long, place long, size long, two array<int>, costs array<double>"


def _fixed(logs: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(logs * STEPS), -(1 << 15), (1 << 15) - 1).astype(np.int16)


def _pack_logs(logs: np.ndarray) -> bytes:
    return shards.pack_numbers(np.ascontiguousarray(logs).reshape(-1).view(np.uint16))


def _unpack_logs(packed: bytes, languages: int) -> np.ndarray:
    return shards.unpack_numbers(packed, np.uint16).view(np.int16).reshape(-1, languages)


def _scores(parts: DataFrame, scored: DataFrame | None, languages: int, buckets: int, plan: Plan) -> DataFrame:
    """Per text: its n-grams, and the two best of these languages by number with
    their bits in all, best first.

    A part sends the hashes of its n-grams in order, by ranges; a range sends them
    back as they came, with a number per language.
    """

    def offered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low = (batch.column(i).to_numpy() for i in range(2))
            logs = _fixed(batch.column(2).flatten().to_numpy().reshape(-1, languages))
            hashes = wide_hash(high, low)
            order = np.argsort(hashes)
            hashes, logs = hashes[order], logs[order]
            for bucket, start, end in shards.runs(shards.shard_of(hashes, buckets)):
                packed = shards.pack_numbers(hashes[start:end], True), _pack_logs(logs[start:end])
                yield shards.one_row(_NAMES, _KINDS, (0, bucket, None, *packed))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def every() -> Iterator[pa.RecordBatch]:
            hashes = np.sort(np.concatenate(held))
            hashes = hashes[np.concatenate([np.ones(1, bool), hashes[1:] != hashes[:-1]])]
            for bucket, start, end in shards.runs(shards.shard_of(hashes, buckets)):
                yield shards.one_row(_NAMES, _KINDS, (1, bucket, at, shards.pack_numbers(hashes[start:end], True), None))

        for part, sizes, packed in _rows(batches):  # labels of a part follow each other
            if held and part != at:
                yield from every()
                held = []
            at = part
            if sizes[0]:
                held.append(wide_hash(*_unpacked(packed, sizes[0])[:2]))
        if held:
            yield from every()

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, known = None, [], None
        for kind, bucket, part, hashes, logs in _rows(batches):
            if bucket != at:
                at, held, known = bucket, [], None
            own = shards.unpack_numbers(hashes, np.uint64, True)
            if kind == 0:
                held.append((own, _unpack_logs(logs, languages)))
                continue
            if known is None:
                all_hashes, all_logs = (np.concatenate(c) for c in zip(*held, strict=True))
                order = np.argsort(all_hashes)
                held, known = [], (all_hashes[order], all_logs[order])
            packed = _pack_logs(known[1][np.searchsorted(known[0], own)])
            yield shards.one_row(_NAMES, _KINDS, (0, bucket, part, hashes, packed))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, labels, sizes, packed, answers in _rows(batches):
            if answers:  # ranges follow each other, so all hashes are in order
                places = Places(np.concatenate([shards.unpack_numbers(x["hashes"], np.uint64, True) for x in answers]))
                values = np.concatenate([_unpack_logs(x["logs"], languages) for x in answers])
            data = zstandard.ZstdDecompressor().stream_reader(packed)
            n, costs = np.zeros(len(ids), np.int64), np.zeros((len(ids), languages), np.int64)
            for i, size in enumerate(sizes):
                points = data.read(size).decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass")
                own = wide_hash(*wide_grams(np.frombuffer(points, np.uint32), plan.order))
                if len(own) and languages:
                    costs[i] = -values[places(own)].sum(axis=0, dtype=np.int64)
                n[i] = len(own)
            two = np.argsort(costs, axis=1, kind="stable")[:, :2]
            least = np.take_along_axis(costs, two, axis=1) / STEPS
            arrays = [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array([part] * len(ids), pa.int64())]
            arrays += [pa.array(np.arange(len(ids))), pa.array(n)]
            arrays += [pa.array(list(two.astype(np.int32)), pa.list_(pa.int32())), pa.array(list(least), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _FOUND.split(", ")])

    texts = parts.where("kind = 0").select("part", "ids", "labels", "sizes", "packed")
    if not languages:
        none = F.lit(None).cast("array<struct<bucket:long,hashes:binary,logs:binary>>")
        return stored(texts.withColumn("answers", none).mapInArrow(judged, _FOUND))
    asking = parts.where("kind = 1").select("part", "sizes", "packed").mapInArrow(asked, _MET)
    offers = scored.select("high", "low", "logs").mapInArrow(offered, _MET)
    met = offers.unionAll(asking).repartition("bucket").sortWithinPartitions("bucket", "kind")
    # A part has one answer per range; together they are as many numbers as it has n-grams.
    answers = met.mapInArrow(answered, _MET).groupBy("part").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "hashes", "logs"))).alias("answers")
    )
    both = texts.join(answers, "part", "left").select(*texts.columns, "answers")
    return stored(both.mapInArrow(judged, _FOUND))


class Places:
    """Where hashes are in a sorted array that has them. Their first bits lead to a
    place at most a few before it, which takes less than to halve the array."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.shift = np.uint64(64 - (max(len(known), 2).bit_length() + 1))
        tops = (known >> self.shift).astype(np.int64)
        counts = np.bincount(tops, minlength=1 << (64 - int(self.shift)))
        self.first = (np.cumsum(counts) - counts).astype(np.int32)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        at = self.first[(wanted >> self.shift).astype(np.int64)]
        behind = np.flatnonzero(self.known[at] != wanted)
        while len(behind):
            at[behind] += 1
            behind = behind[self.known[at[behind]] != wanted[behind]]
        return at


def _best(turns: list[DataFrame], languages: int, each: int) -> DataFrame:
    """Best language by number (-1: none) of each text, its bits per symbol, and how
    far the next one lies behind, over the turns."""
    shown = [t.withColumn("two", F.expr(f"transform(two, x -> x + {i * each})")) for i, t in enumerate(turns)]
    if len(shown) == 1:
        every = shown[0]
    else:
        united = shown[0]
        for turn in shown[1:]:
            united = united.unionAll(turn)
        # A text is in one row per turn.
        every = united.groupBy("part", "place").agg(
            F.first("id").alias("id"), F.first("lang").alias("lang"), F.first("size").alias("size"),
            F.flatten(F.collect_list("two")).alias("two"), F.flatten(F.collect_list("costs")).alias("costs"),
        )
    pairs = F.array_sort(F.zip_with("costs", "two", lambda c, t: F.struct(c.alias("cost"), t.alias("language"))))
    some = (F.col("size") > 0) & F.lit(languages > 0)
    first, second = F.get(pairs, F.lit(0)), F.get(pairs, F.lit(1))
    behind = second["cost"] - first["cost"] if languages > 1 else F.col("size").cast("double")
    return every.select(
        "id", "lang",
        F.when(some, first["language"]).otherwise(-1).alias("best"),
        F.when(some, first["cost"] / F.col("size")).otherwise(0.0).alias("bits"),
        F.when(some, F.log1p(behind)).otherwise(0.0).alias("margin"),
    )


def language_id(
    docs: DataFrame, *, plan: Plan = Plan(), key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per document: held_out, lang_pred, score, bits per symbol, and
    whether it is rejected as being in no learned language.

    Models see labelled documents whose crc32 of the id leaves a remainder other
    than 2 by 4; a prediction sees the text alone. Null texts, texts without a
    letter, and all texts if nothing was learned are `und` with score 0. Ties go
    to the language first in order. A text is rejected if it needs far more bits
    than its language's documents do, or has no language. Very long texts are
    scored whole, repeated rows alike; other columns are ignored; no rows give
    no rows.
    """
    remainder = F.crc32(F.col(key).cast("long").cast("string").cast("binary")) % 4
    each = docs.select(
        F.col(key).cast("long").alias("id"),
        F.col(text).cast("string").alias("text"),
        F.col(lang).cast("string").alias("lang"),
        (remainder == 2).alias("held_out"),
    )
    labelled = ~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()
    spark = docs.sparkSession
    counted = Scratch(spark)
    parts = _parts(each.withColumn("label", F.when(labelled, F.col("lang"))), plan, counted)
    counts = counted.written(_counts(parts))
    train = counts.where("label is not null")
    learned = Learned(sorted(r["label"] for r in train.select("label").distinct().collect()))
    turns, buckets = [], 1
    if learned.languages:
        wanted = counted.written(counts.select("high", "low").distinct())
        buckets = max(1, -(-wanted.count() // plan.bucket))
    for start in range(0, len(learned.languages), plan.languages):
        names = learned.languages[start : start + plan.languages]
        tables, scored = Scratch(spark), Scratch(spark)
        models = learn(train.where(F.col("label").isin(names)), plan.order, tables)
        logs = scored.written(score_grams(wanted, models, names))
        tables.clear()
        turns.append(_scores(parts, logs, len(names), buckets, plan))
        scored.clear()
    turns = turns or [_scores(parts, None, 0, 1, plan)]
    counted.clear()
    found = _best(turns, len(learned.languages), plan.languages)
    if learned.languages:
        fitted = Scratch(spark)
        _calibrate(learned, found, fitted)
        fitted.clear()
    names = F.array(*[F.lit(x) for x in learned.languages]) if learned.languages else F.array(F.lit(UNDECIDED))
    limits = [learned.most_bits.get(x, float("inf")) for x in learned.languages] or [0.0]
    limit = F.get(F.array(*[F.lit(float(x)) for x in limits]), F.col("best"))
    some = F.col("best") >= 0
    sure = 1 / (1 + F.exp(-(F.col("margin") * learned.slope + learned.offset)))
    return found.select(
        F.col("id").alias(key),
        (F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2).alias("held_out"),
        F.when(some, F.get(names, F.col("best"))).otherwise(UNDECIDED).alias("lang_pred"),
        F.when(some, sure).otherwise(0.0).alias("score"),
        "bits",
        (~some | (F.col("bits") > limit)).alias("rejected"),
    )
