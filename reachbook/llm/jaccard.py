"""N-gram Jaccard join by vertical partitioning.

The n-grams of all documents have one global order, that of their hashes. It is
cut into fragments, and so is every document's set.

* Two sets that are similar enough differ in at most D n-grams, hence in at most
  D fragments. Cut into more than D, some of their fragments are equal, and it is
  known how many at least. D grows with the size of a set, so sets are cut per
  size class; a set is cut for every class in which it can have a partner as
  large or larger.
* Two sets that share too few fragments are no candidates. Those that share a
  fragment with few others are counted in pairs; where many share one, each points
  to the least of them, not to all, and is left out if all it shares with others
  is too little. What is left forms candidate groups, which lose no link; else sets
  that have a phrase or two in common would chain most of a large corpus.
* Candidate groups are cut into blocks and every two blocks meet in one task.
  There the overlap of a pair is counted fragment by fragment and summed; a pair
  is given up as soon as the fragments left cannot make up for what is missing.
  Pairs that earlier links already join are not counted again, and only the links
  that join something leave the task: no task writes all pairs of a group.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.llm.common import components, distinct_sorted, in_batches, mix, numbered_rows, packed_texts, release, stored

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_FOLD = bytes.maketrans(_UPPER, _LOWER)

#: Bits of a set's hash that name it among candidates.
VERTEX = (1 << 40) - 1
#: Added to the shared signatures of two sets that share one with many.
MANY = 1 << 32


@dataclass(frozen=True)
class Join:
    """Distinct n-grams of `words` words; links from `percent` % similarity on.

    A quarter more fragments than needed and `spare` are cut. `growth` is the
    width of a size class. Blocks hold about `block_grams` n-grams and
    `block_rows` sets. At most `common` n-grams are left out of signatures. Up to
    `few` sets that share a fragment are paired. None of these changes a result.
    """

    words: int = 3
    percent: int = 90
    spare: int = 2
    growth: float = 1.5
    block_grams: int = 1_500_000
    block_rows: int = 4096
    signs_at_once: int = 1 << 20
    common: int = 200_000
    few: int = 8
    count_fragments: int = 8

    def most_apart(self, grams: int) -> int:
        """The n-grams in which two linked sets differ at most, if the larger has `grams`."""
        union = 200 * grams // (100 + self.percent)
        return union * (100 - self.percent) // 100

    def classes(self, largest: int) -> list[int]:
        """Where size classes start, up to the class of `largest`. The first one
        ends where sets begin to be linked to different ones."""
        starts = [1]
        while not self.most_apart(starts[-1]):
            starts[-1] += 1
        starts.insert(0, 0)
        while starts[-1] <= largest:
            starts.append(max(starts[-1] + 1, int(starts[-1] * self.growth)))
        return starts

    def linked(self, shared: int, one: int, two: int) -> bool:
        return 100 * shared >= self.percent * (one + two - shared)


def gram_set(data: bytes, words: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams; with fewer words, of the whole sequence."""
    tokens = data.translate(_FOLD).split()
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, n)
    width = min(n, words)
    grams = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - width + 1 + i])
    return distinct_sorted(grams)


class Signer:
    """Signatures of a set's fragments, one list per size class it can have partners in.

    Fragments of common n-grams are shared by documents that have little else in
    common, so they are left out: two linked sets also differ in at most D of
    the others. What they share may then be empty fragments only. So sets with
    more empty fragments than the spare ones, and only those, are cut again,
    elsewhere, and at last with all their n-grams; whatever is common, no link
    is lost.
    """

    def __init__(self, join: Join, common: np.ndarray):
        self.join, self.common = join, common
        self.starts = join.classes(1 << 16)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        return self.signed(grams)[0]

    def signed(self, grams: np.ndarray) -> tuple[np.ndarray, int]:
        """The signatures, and how many of them any linked set has at least. Of
        fragments that are equal, those that are empty in both have none; if this
        set has no more empty ones than the spare ones, its first cut is compared
        with the first cut of every linked set."""
        join, n = self.join, len(grams)
        partner = 100 * n // join.percent
        if partner >= self.starts[-1]:
            self.starts = join.classes(2 * partner)
        rare = grams
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, grams), len(self.common) - 1)
            rare = grams[self.common[at] != grams]
        own, least = [], []
        for size_class in range(max(1, bisect_right(self.starts, n) - 1), bisect_right(self.starts, partner)):
            apart = join.most_apart(self.starts[size_class + 1] - 1)
            spare = join.spare + apart // 4
            for turn, chosen in enumerate((rare, rare, rare, grams)):
                signs, empty = self._cut(chosen, apart + 1 + spare, size_class, turn)
                short = int(empty.sum()) > spare
                if not turn:
                    least.append(1 if short else 1 + spare - int(empty.sum()))
                own.append(signs if short and turn == 3 else signs[~empty])
                if not short:
                    break
        return (np.concatenate(own), min(least)) if own else (np.empty(0, np.uint64), 1)

    def _cut(self, grams: np.ndarray, fragments: int, size_class: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
        if turn:
            grams = np.sort(mix(grams ^ np.uint64(turn << 60 | 1)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams), dtype=np.uint64)])
        edges = np.arange(1, fragments, dtype=np.uint64) * np.uint64((1 << 64) // fragments)
        ends = np.concatenate([[0], np.searchsorted(grams, edges), [len(grams)]])
        sizes = np.diff(ends).astype(np.uint64)
        names = mix(np.arange(fragments, dtype=np.uint64) + np.uint64(size_class << 40 | turn << 56))
        return mix(sums[ends[1:]] - sums[ends[:-1]] + names + sizes), sizes == 0


def _common(docs: DataFrame, join: Join) -> np.ndarray:
    """Hashes of n-grams that many documents have: a bounded list, the most
    frequent first. Each task counts what it holds in turns, and n-grams that
    are there twice go on. The list decides how many candidates there are, never
    what is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            twice = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(grams[twice].view(np.int64)), pa.array(counts[twice].astype(np.int64))], ["gram", "n"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(gram_set((text or "").encode(), join.words))
                size += len(held[-1])
                if size >= join.signs_at_once:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    counts = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = stored(counts.select("gram", F.floor(F.log2("n") * 4).alias("level")))
    room, least = join.common, None
    for row in sorted(counts.groupBy("level").count().collect(), reverse=True):
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    if least is None:
        return np.empty(0, np.uint64)
    rows = counts.where(F.col("level") >= least).select("gram").toArrow()
    return np.sort(rows.column("gram").to_numpy().view(np.uint64))


def _sets(docs: DataFrame, join: Join) -> DataFrame:
    """(doc_id, n_grams, one, two): size of each set, and its hash in two halves."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, halves = [], []
        for text in batch.column(1).to_pylist():
            grams = gram_set((text or "").encode(), join.words)
            sizes.append(len(grams))
            halves.append(np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), np.int64))
        both = np.array(halves)
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_grams", "one", "two"])

    return in_batches(docs, step, "doc_id long, n_grams long, one long, two long")


def _vertex(grams: np.ndarray) -> int:
    """The first bits of a set's hash, as in the column `one` of _sets()."""
    return int.from_bytes(xxhash.xxh3_128_digest(grams.tobytes())[:8], "little") & VERTEX


def _summed(a: np.ndarray, b: np.ndarray, n: np.ndarray, least: np.ndarray) -> list[np.ndarray]:
    """Each pair once, with the sum of its counts and the least of its bounds."""
    order = np.lexsort((b, a))
    a, b, n, least = (x[order] for x in (a, b, n, least))
    heads = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.empty(0, np.int64)
    if not len(heads):
        return [a, b, n, least]
    return [a[heads], b[heads], np.add.reduceat(n, heads), np.minimum.reduceat(least, heads)]


def _planes(signs: np.ndarray, sets: np.ndarray, least: np.ndarray) -> bytes:
    """Entries in the order of their signatures, as planes of bytes, to be compressed."""
    steps = np.diff(signs, prepend=np.uint64(0))
    planes = [x.view(np.uint8).reshape(len(x), -1).T[:width] for x, width in ((steps, 8), (sets, 5), (least, 2))]
    return np.concatenate(planes).tobytes()


def _entries(planes: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(planes, np.uint8).reshape(15, -1)
    sets = np.zeros((planes.shape[1], 8), np.uint8)
    sets[:, :5] = planes[8:13].T
    steps, least = (np.ascontiguousarray(x.T).view(t).ravel() for x, t in ((planes[:8], np.uint64), (planes[13:], np.uint16)))
    return np.cumsum(steps, dtype=np.uint64), sets.view(np.uint64).ravel(), least


def _heads(signs: np.ndarray, sets: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """Entries in order, each once; where each one's signature begins, and its number of entries."""
    order = np.lexsort((sets, signs))
    signs, sets, least = signs[order], sets[order], least[order]
    once = np.ones(len(signs), bool)
    once[1:] = (signs[1:] != signs[:-1]) | (sets[1:] != sets[:-1])
    signs, sets, least = signs[once], sets[once], least[once]
    heads = np.flatnonzero(np.concatenate([[True], signs[1:] != signs[:-1]]))
    sizes = np.diff(np.append(heads, len(signs)))
    return signs, sets, least, np.repeat(heads, sizes), np.repeat(sizes, sizes)


def _star(hubs: np.ndarray, sets: np.ndarray, least: np.ndarray) -> list[np.ndarray]:
    """Each set and its hub are joined for good; what it shares with many is counted under itself."""
    apart = hubs != sets
    joined = _summed(hubs[apart], sets[apart], np.full(int(apart.sum()), MANY), least[apart].astype(np.int64))
    joined[2][:] = MANY
    counted = _summed(sets, sets, np.ones(len(sets), np.int64), least.astype(np.int64))
    return [np.concatenate(x) for x in zip(joined, counted, strict=True)]


def _shared(docs: DataFrame, join: Join, buckets: int) -> DataFrame:
    """(a, b, n, least): sets a < b share n signatures, and at least `least` if they
    are linked; MANY and more: they share one with many. a = b: the signatures that
    a shares with many, and those that it shares at least with any linked set.

    Sets go by the first bits of their hash, so copies are one set from the start.
    A task first joins what it holds itself and sends on a few sets per signature,
    so a signature that a third of all sets have is no more than a few rows per
    task. Signatures travel in buckets of their first bits, packed.
    """
    common = _common(docs, join) if join.common else np.empty(0, np.uint64)
    release(docs.sparkSession)  # counts of all n-grams, before the signatures come
    few = join.few

    def bucketed(signs: list[np.ndarray], sets: list[int], least: list[int]) -> pa.RecordBatch:
        sizes = [len(x) for x in signs]
        each = (np.repeat(np.array(x, t), sizes) for x, t in ((sets, np.uint64), (np.minimum(least, 65535), np.uint16)))
        every, of, bound, heads, count = _heads(np.concatenate(signs), *each)
        place = np.arange(len(every)) - heads
        star = place > few
        found = _star(of[heads[star]].view(np.int64), of[star].view(np.int64), bound[star])
        every, of, bound = every[~star], of[~star], bound[~star]
        spread = mix(found[0].astype(np.uint64) * np.uint64(3) + found[1].astype(np.uint64)) % np.uint64(buckets)
        order = np.argsort(spread)
        known, spread = np.stack(found)[:, order], spread[order]
        all_buckets = np.arange(buckets + 1, dtype=np.uint64)
        at = np.searchsorted((every >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), all_buckets)
        known_at = np.searchsorted(spread, all_buckets)
        press = zstandard.ZstdCompressor(level=1).compress
        rows = []
        for bucket in np.flatnonzero(np.diff(at) + np.diff(known_at)).tolist():
            own = slice(at[bucket], at[bucket + 1])
            also = known[:, known_at[bucket] : known_at[bucket + 1]]
            rows.append((bucket, press(_planes(every[own], of[own], bound[own])), press(also.tobytes())))
        types = [pa.int32(), pa.binary(), pa.binary()]
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "packed", "known"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, signs, of, least, held = Signer(join, common), [], [], [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                grams = gram_set((text or "").encode(), join.words)
                own, bound = signer.signed(grams)
                if len(own):
                    signs.append(own)
                    of.append(_vertex(grams))
                    least.append(bound)
                    held += len(own)
                if held >= join.signs_at_once:
                    yield bucketed(signs, of, least)
                    signs, of, least, held = [], [], [], 0
        if held:
            yield bucketed(signs, of, least)

    def met(entries: list[tuple], known: list[np.ndarray]) -> pa.RecordBatch:
        signs, sets, least, heads, sizes = _heads(*(np.concatenate(x) for x in zip(*entries, strict=True)))
        sets = sets.view(np.int64)
        many = sizes > few
        found = [*known, _star(sets[heads[many]], sets[many], least[many])]
        least = least.astype(np.int64)
        for step in range(1, few):
            at = np.flatnonzero(~many[:-step] & (heads[:-step] == heads[step:]))
            pair = sets[at], sets[at + step]
            found.append([*pair, np.ones(len(at), np.int64), np.maximum(least[at], least[at + step])])
        columns = _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b", "n", "least"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        last, entries, known = None, [], []
        for batch in batches:
            for bucket, packed, sent in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != last and entries:
                    yield met(entries, known)
                    entries, known = [], []
                last = bucket
                entries.append(_entries(unpack(packed)))
                known.append(np.frombuffer(unpack(sent), np.int64).reshape(4, -1))
        if entries:
            yield met(entries, known)

    signed = docs.select("text").mapInArrow(sign, "bucket int, packed binary, known binary")
    found = signed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "a long, b long, n long, least long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("least").alias("least"))


def _groups(shared: DataFrame) -> DataFrame:
    """(vertex, group) of the sets that may be linked with others, from _shared()."""
    pairs = shared.where("a <> b")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"), (F.col("n") % MANY).alias("n"))
    best = ends.where("n > 0").groupBy("id").agg(F.max("n").alias("best"))
    alone = shared.where("a = b").select(F.col("a").alias("id"), "n", "least").join(best, "id", "left")
    alone = alone.where(F.col("n") + F.coalesce("best", F.lit(0)) < F.col("least")).select("id")
    groups = components(pairs.where("n >= least").select("a", "b")).join(alone, "id", "left_anti")
    return groups.select(F.col("id").alias("vertex"), F.col("component").alias("group"))


class Sets:
    """The sets of one block pair, and what links are known among them."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], join: Join):
        self.join, self.ids, self.sets = join, ids, sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.parent = np.arange(len(ids))
        self.bits = self._bits()
        self.cuts: dict[int, np.ndarray] = {}

    def _bits(self) -> np.ndarray:
        """Parity of the n-grams in each of many buckets. Every n-gram in which
        two sets differ flips one bit, so bits that differ bound them from below."""
        width = 256
        while width < min(4096, int(self.sizes.max(initial=0))):
            width *= 2
        parity = np.zeros((len(self.sets), width), np.uint8)
        for row, grams in zip(parity, self.sets, strict=True):
            row[:] = np.bincount((mix(grams) % np.uint64(width)).astype(np.int64), minlength=width) & 1
        return np.packbits(parity, axis=1).view(np.uint64)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def _fragments(self, i: int) -> np.ndarray:
        if i not in self.cuts:
            n = self.join.count_fragments
            edges = np.arange(1, n, dtype=np.uint64) * np.uint64((1 << 64) // n)
            self.cuts[i] = np.concatenate([[0], np.searchsorted(self.sets[i], edges), [self.sizes[i]]])
        return self.cuts[i]

    def similar(self, i: int, j: int) -> bool:
        """Sum the overlaps of the fragments, as long as they can suffice."""
        cut_i, cut_j = self._fragments(i), self._fragments(j)
        possible = np.minimum(np.diff(cut_i), np.diff(cut_j))
        ahead, shared = int(possible.sum()), 0
        one, two = int(self.sizes[i]), int(self.sizes[j])
        for k, most in enumerate(possible):
            if not self.join.linked(shared + ahead, one, two):
                return False
            a, b = self.sets[i][cut_i[k] : cut_i[k + 1]], self.sets[j][cut_j[k] : cut_j[k + 1]]
            if len(a) and len(b):
                at = np.searchsorted(b, a)
                at[at == len(b)] = 0
                shared += int(np.count_nonzero(b[at] == a))
            ahead -= int(most)
        return self.join.linked(shared, one, two)

    def link(self, rows: range, columns: range) -> Iterator[tuple[int, int]]:
        """Links between rows and columns that join what was not joined yet."""
        for i in rows:
            first = max(columns.start, i + 1) if columns.start <= i else columns.start
            others = np.arange(first, columns.stop)
            both = self.sizes[i] + self.sizes[others]
            apart = np.bitwise_count(self.bits[others] ^ self.bits[i]).sum(axis=1, dtype=np.int64)
            near = others[apart * (100 + self.join.percent) <= both * (100 - self.join.percent)]
            for j in near.tolist():
                one, two = self.root(i), self.root(j)
                if one != two and self.similar(i, j):
                    self.parent[max(one, two)] = min(one, two)
                    yield self.ids[i], self.ids[j]


def _links(docs: DataFrame, members: DataFrame, join: Join) -> DataFrame:
    """(a, b): links that join each candidate group's components. `members` has
    (doc_id, group, blocks): one document per distinct set."""
    needed = packed_texts(docs).join(members, "doc_id")
    names = ["group", "i", "j", "block", "doc_id", "packed"]

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, packed, group, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = xxhash.xxh3_64_intdigest(doc.to_bytes(8, "little", signed=True)) % blocks
            rows += [(group, min(own, k), max(own, k), own, doc, packed) for k in range(blocks)]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
        )

    needed = needed.select("doc_id", "packed", "group", "blocks")
    blocks = in_batches(needed, deal, "group long, i int, j int, block int, doc_id long, packed binary", rows=64)
    dealt = blocks.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "block", "doc_id")
    unpack = zstandard.decompress

    def linked(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        """Links of one block pair."""
        ids, sets, own = [], [], []
        for _, _, _, block, doc, packed in rows:
            ids.append(doc)
            sets.append(gram_set(unpack(packed), join.words))
            own.append(block)
        if len(ids) < 2:
            return
        _, i, j = rows[0][:3]
        known = Sets(ids, sets, join)
        if i == j:
            yield from known.link(range(len(ids)), range(len(ids)))
        else:
            border = bisect_right(own, i)
            yield from known.link(range(border), range(border, len(ids)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and rows[0][:3] != row[:3]:
                    found += linked(rows)
                    rows = []
                rows.append(row)
            if found:
                yield _pairs(found)
                found = []
        if rows:
            found += linked(rows)
        if found:
            yield _pairs(found)

    return dealt.mapInArrow(run, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])


def jaccard_rows(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """(doc_id, n_grams, component_id) of rows (doc_id, text), each with an id of its own."""
    sets = stored(_sets(docs, join))
    classes = stored(sets.where("n_grams > 0").groupBy("one", "two").agg(F.min("doc_id").alias("doc_id"), F.max("n_grams").alias("n_grams")))
    grams = sets.agg(F.sum("n_grams")).first()[0] or 0
    shared = stored(_shared(docs, join, 1 + 4 * grams // join.signs_at_once))
    release(docs.sparkSession)  # signatures are most of what is shuffled
    # Sets that are alone are kept: another one may have the same first bits.
    candidates = classes.withColumn("vertex", F.col("one").bitwiseAND(VERTEX)).join(_groups(shared), "vertex", "left")
    candidates = stored(candidates.select("doc_id", "n_grams", F.coalesce("group", "vertex").alias("group")))
    release(docs.sparkSession)
    totals = candidates.groupBy("group").agg(F.sum("n_grams").alias("grams"), F.count("*").alias("sets"))
    blocks = F.greatest(F.ceil(F.col("grams") / join.block_grams), F.ceil(F.col("sets") / join.block_rows))
    totals = stored(totals.where("sets > 1").select("group", blocks.cast("int").alias("blocks")))
    members = stored(candidates.join(totals, "group").select("doc_id", "group", "blocks"))
    joined = components(_links(docs, members, join)).withColumnRenamed("id", "doc_id")
    classes = stored(
        classes.join(joined, "doc_id", "left").select("one", "two", F.coalesce("component", "doc_id").alias("component"))
    )
    release(docs.sparkSession)
    # Sets without n-grams have no class, so they keep their own id.
    return sets.join(classes, ["one", "two"], "left").select(
        "doc_id", "n_grams", F.coalesce("component", "doc_id").alias("component_id")
    )


def jaccard_components(
    docs: DataFrame, join: Join = Join(), *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: n_grams, and the component of the links.

    Two documents are linked if `percent` % of the n-grams in either are in both.
    A component's id is its smallest document's. Null, empty and blank texts have
    no n-grams and are linked with nothing. Equal sets are compared once, by
    their smallest document, so copies cost no more than their text. Each row is
    a document, whatever its id: rows may share one, with the same text or not,
    and rows without an id link like others; a component of such rows alone has
    none. Other columns are ignored; very long texts are cut into n-grams whole;
    no rows give no rows.
    """
    rows = numbered_rows(docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")))
    found = jaccard_rows(rows.select(F.col("row").alias("doc_id"), "text"), join)
    found = stored(found.join(rows.select(F.col("row").alias("doc_id"), "id"), "doc_id"))
    least = found.groupBy("component_id").agg(F.min("id").alias("least"))
    return found.join(least, "component_id").select(
        F.col("id").alias(key), "n_grams", F.coalesce("least", "id").alias("component_id")
    )
