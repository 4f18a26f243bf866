"""Removal of long repeated strings with suffix arrays, two-stage sorted.

1. Every string of `length` bytes holds a run of `gram`-byte strings; the one
   with the least hash is its anchor. Equal strings have equal anchors, so only
   strings whose anchor occurs twice can be repeated: the text around those
   anchors, and nothing else, is gathered, one bucket per anchor.
2. A task joins its buckets' text and builds a suffix array of it in two stages:
   only suffixes smaller than their successors are sorted directly, all others
   are induced from these by scanning the buckets of first bytes in order. The
   common prefixes of neighbours tell which strings occur again.
3. Buckets too large for a task are shared out by the hash of each whole string
   instead, summed up before the shuffle.

Documents that are equal as a whole are settled at once and take part as one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.llm.common import in_batches, mix, numbered_rows, packed_texts, stored, unpacked, written

#: No byte of a UTF-8 text: it ends a piece of text.
END = 0xFF
#: Bytes of a very long text whose anchors are searched at once.
STRETCH = 1 << 22
#: Suffixes that are compared byte by byte at once.
COMPARED = 1 << 15


@dataclass(frozen=True)
class Repeats:
    """Strings of `length` bytes. Buckets of over `hot` documents are
    shared out; a suffix array covers about `array_bytes`, whole buckets."""

    length: int = 200
    gram: int = 32
    hot: int = 16_000
    array_bytes: int = 400_000


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one big-endian number."""
    count = len(data) - 7
    out = np.empty(max(count, 0), np.uint64)
    for shift in range(min(8, count)):
        whole = (len(data) - shift) // 8 * 8
        out[shift::8] = data[shift : shift + whole].view(">u8")
    return out


def _hashes(words: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of the `width` bytes from each position on; width is at least 8."""
    offsets = [*range(0, width - 8, 8), width - 8]
    factors = mix(np.arange(1, len(offsets) + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)
    count = len(words) - (width - 8)
    out = np.zeros(max(count, 0), np.uint64)
    for offset, factor in zip(offsets, factors, strict=True):
        # High bits of a word must reach the low ones before the next round.
        part = words[offset : offset + len(out)] * factor
        out += part ^ (part >> np.uint64(29))
    return mix(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: bytes, spec: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hashes in order, and where the strings of each start, with an end."""
    total = len(data) - spec.length + 1
    keys, starts = [], []
    for base in range(0, max(total, 0), STRETCH):
        part = np.frombuffer(data, np.uint8, min(len(data) - base, STRETCH + spec.length - 1), base)
        hashes = _hashes(words_at(part), spec.gram, 1)
        # The position breaks ties: the first one, in any place the string occurs.
        place = np.uint64(24)
        ranked = hashes >> place << place | np.arange(len(hashes), dtype=np.uint64)
        at = (_least(ranked, spec.length - spec.gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        turns = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        keys.append(hashes[at[turns]])
        starts.append(turns + base)
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate([*starts, [total]])


def _in_order(text: np.ndarray, starts: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """Starts in order of the `depth` bytes there. Large sets are dealt out by
    one byte after the other, small ones compared."""
    todo = [(starts, 0)]
    while todo:
        own, at = todo.pop()
        if len(own) <= COMPARED or at == depth:
            if at < depth and len(own) > 1:
                keys = np.lib.stride_tricks.sliding_window_view(text, depth - at)[own + at]
                own = own[np.argsort(keys.view(f"S{depth - at}").ravel())]
            yield own
            continue
        bytes_here = text[own + at]
        order = np.argsort(bytes_here, kind="stable")
        own, bytes_here = own[order], bytes_here[order]
        turns = np.flatnonzero(np.diff(bytes_here)) + 1
        todo += [(part, at + 1) for part in reversed(np.split(own, turns))]


def two_stage(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of bytes, right in the first `depth` bytes of each suffix."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16), append=-1))
    # A run of equal bytes goes the way its end goes.
    following = np.where(step != 0, np.arange(n, dtype=np.int32), np.int32(n - 1))
    following = np.minimum.accumulate(following[::-1])[::-1]
    rising = step[following] > 0  # smaller than its successor
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    direct = np.concatenate([*_in_order(padded, np.flatnonzero(rising).astype(np.int32), depth), np.empty(0, np.int32)])
    first = text[direct]
    bounds = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    # The last suffix is induced by the empty one after it.
    waiting[int(text[n - 1])].append(np.array([n - 1], np.int32))
    out = []
    del following, step, padded
    for byte in range(256):
        induced = []
        fresh = np.concatenate(waiting[byte]) if waiting[byte] else np.empty(0, np.int32)
        waiting[byte] = []
        while len(fresh):
            induced.append(fresh)
            before = fresh[fresh > 0] - 1
            fresh = before[(text[before] == byte) & ~rising[before]]
        scanned = np.concatenate([*induced, direct[bounds[byte] : bounds[byte + 1]]])
        out.append(scanned)
        before = scanned[scanned > 0] - 1
        before = before[text[before] > byte]
        if len(before):
            symbols = text[before]
            order = np.argsort(symbols, kind="stable")
            symbols, before = symbols[order], before[order]
            turns = np.concatenate([[0], np.flatnonzero(np.diff(symbols)) + 1, [len(symbols)]])
            for low, high in zip(turns[:-1], turns[1:], strict=True):
                waiting[int(symbols[low])].append(before[low:high])
    return np.concatenate(out)


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece of text, which of its strings of `length` bytes start
    again elsewhere in the pieces. Every piece holds at least one."""
    text = np.frombuffer(bytes([END]).join([*pieces, b""]), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    array = two_stage(text, length)
    whole = np.zeros(len(text), bool)
    for begin, size in zip(begins, sizes, strict=True):
        whole[begin : begin + size - length + 1] = True
    array = array[whole[array]]
    words = words_at(np.concatenate([text, np.zeros(8, np.uint8)]))
    # Neighbours whose common prefix reaches the length.
    alike = np.arange(len(array) - 1)
    for offset in [*range(0, length - 8, 8), length - 8]:
        alike = alike[words[array[alike] + offset] == words[array[alike + 1] + offset]]
    again = np.zeros(len(text), bool)
    again[array[alike]] = True
    again[array[alike + 1]] = True
    return [again[b : b + s - length + 1] for b, s in zip(begins, sizes, strict=True)]


def _runs(flags: np.ndarray, start: int, length: int) -> Iterator[tuple[int, int]]:
    """Byte ranges covered by the strings that the flags mark."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        yield start + low, start + high - 1 + length


def _scanned(docs: DataFrame, spec: Repeats) -> DataFrame:
    """Per document: size, hash of the text in two halves, its digest, its
    distinct anchors and those that it has twice."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, halves, digests, keys, twice = [], [], [], [], []
        for value in batch.column(1).to_pylist():
            data = (value or "").encode()
            distinct, counts = np.unique(anchors(data, spec)[0], return_counts=True)
            sizes.append(len(data))
            halves.append(np.frombuffer(xxhash.xxh3_128_digest(data), np.int64))
            digests.append(hashlib.sha256(data).hexdigest())
            keys.append(distinct.view(np.int64))
            twice.append(distinct[counts > 1].view(np.int64))
        both = np.array(halves)
        columns = [pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(digests)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, _lists(keys), _lists(twice)],
            ["doc_id", "n_bytes", "one", "two", "sha", "keys", "twice"],
        )

    schema = "doc_id long, n_bytes long, one long, two long, sha string, keys array<long>, twice array<long>"
    return in_batches(docs, step, schema)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))


def _wanted(scanned: DataFrame, firsts: DataFrame, spec: Repeats) -> DataFrame:
    """(doc_id, cold, hot): the anchors that also occur elsewhere, of one
    document per distinct text; hot ones have buckets too large for a task."""
    # An anchor that a text has twice counts as if another document had it.
    seen = scanned.select(F.explode("keys").alias("key"), "doc_id").unionAll(
        scanned.select(F.explode("twice").alias("key"), (-1 - F.col("doc_id")).alias("doc_id"))
    )
    repeated = seen.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    repeated = stored(repeated.where("low <> high").select("key", (F.col("n") > spec.hot).alias("is_hot")))
    each = scanned.select("doc_id", F.explode("keys").alias("key")).join(repeated, "key").join(firsts, "doc_id")
    return each.groupBy("doc_id").agg(
        F.collect_list(F.when(~F.col("is_hot"), F.col("key"))).alias("cold"),
        F.collect_list(F.when(F.col("is_hot"), F.col("key"))).alias("hot"),
    )


def _strings(data: bytes, wanted: list[int], spec: Repeats) -> Iterator[tuple[int, int, int]]:
    """Anchor, start and stop of the strings with one of the wanted anchors."""
    keys, starts = anchors(data, spec)
    keys = keys.view(np.int64)
    for i in np.flatnonzero(np.isin(keys, np.array(wanted, np.int64))).tolist():
        yield int(keys[i]), int(starts[i]), int(starts[i + 1])


def _segments(texts: DataFrame, spec: Repeats) -> DataFrame:
    """(key, doc_id, lows, highs, often, segment): the text of a bucket that one
    task sorts, once per document however often it is there. Places that touch or
    overlap, as in periodic text, are one stretch."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for doc, data, wanted in unpacked(batch):
            found: dict[tuple[int, bytes], list] = {}
            for key, start, stop in _strings(data, wanted, spec):
                end = stop - 1 + spec.length
                own = found.setdefault((key, data[start:end]), [[], [], False])
                own[2] = bool(own[0])
                if own[0] and start <= own[1][-1]:
                    own[1][-1] = end
                else:
                    own[0].append(start)
                    own[1].append(end)
            rows += [(key, doc, *own, piece) for (key, piece), own in found.items()]
        if not rows:
            return None
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.bool_(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
            ["key", "doc_id", "lows", "highs", "often", "segment"],
        )

    cold = texts.where(F.size("cold") > 0).select("doc_id", "packed", "cold")
    schema = "key long, doc_id long, lows array<int>, highs array<int>, often boolean, segment binary"
    return in_batches(cold, cut, schema, rows=64)


def _sorted_spans(segments: DataFrame, spec: Repeats) -> DataFrame:
    """(doc_id, low, high): bytes covered by repeated strings, from suffix arrays."""

    def spans(buckets: list[dict[bytes, list[tuple]]]) -> Iterator[tuple[int, int, int]]:
        # One string of an anchor's text has one place in it, so a bucket whose
        # text is all the same needs no sorting.
        pieces = [piece for found in buckets if len(found) > 1 for piece in found]
        flags = dict(zip(pieces, repeated_starts(pieces, spec.length), strict=True)) if pieces else {}
        covered: dict[int, list[tuple[int, int]]] = {}
        for found in buckets:
            for piece, places in found.items():
                # Text that is there twice is repeated throughout.
                if len(places) > 1 or places[0][3]:
                    for doc, lows, highs, _ in places:
                        covered.setdefault(doc, []).extend(zip(lows, highs, strict=True))
                elif piece in flags:
                    doc, (start,), _, _ = places[0]
                    covered.setdefault(doc, []).extend(_runs(flags[piece], start, spec.length))
        for doc, ranges in covered.items():
            for low, high in _united(ranges):
                yield doc, low, high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, size, buckets, out = None, 0, [], []
        for batch in batches:
            for key, doc, lows, highs, often, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != at:
                    if size > spec.array_bytes:
                        out += spans(buckets)
                        size, buckets = 0, []
                    buckets.append({})
                    at = key
                if piece not in buckets[-1]:
                    size += len(piece)
                buckets[-1].setdefault(piece, []).append((doc, lows, highs, often))
            if out:
                yield _spans_batch(out)
                out = []
        out += spans(buckets)
        if out:
            yield _spans_batch(out)

    dealt = segments.repartition("key").sortWithinPartitions("key", "doc_id")
    return dealt.mapInArrow(run, "doc_id long, low long, high long")


def _united(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Ranges that touch or overlap, as one."""
    low = high = -1
    for start, stop in sorted(ranges):
        if start > high:
            if high >= 0:
                yield low, high
            low = start
        high = max(high, stop)
    if high >= 0:
        yield low, high


def _spans_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "low", "high"]
    )


def _hot_spans(texts: DataFrame, spec: Repeats) -> DataFrame:
    """The same from shared-out buckets: each string by its 128-bit hash."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        columns = [[], [], [], []]
        for doc, data, wanted in unpacked(batch):
            whole = np.frombuffer(data, np.uint8)
            for _, start, stop in _strings(data, wanted, spec):
                words = words_at(whole[start : stop - 1 + spec.length])
                columns[0].append(np.full(stop - start, doc, np.int64))
                columns[1].append(np.arange(start, stop))
                columns[2].append(_hashes(words, spec.length, 2).view(np.int64))
                columns[3].append(_hashes(words, spec.length, 3).view(np.int64))
        if not columns[0]:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["doc_id", "start", "one", "two"])

    texts = texts.where(F.size("hot") > 0).select("doc_id", "packed", "hot")
    strings = stored(in_batches(texts, cut, "doc_id long, start long, one long, two long", rows=16))
    twice = stored(strings.groupBy("one", "two").count().where("count > 1").select("one", "two"))
    return strings.join(twice, ["one", "two"]).select(
        "doc_id", F.col("start").alias("low"), (F.col("start") + spec.length).alias("high")
    )


def suffix_dedup(docs: DataFrame, spec: Repeats = Repeats(), *, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: size in bytes, bytes and spans removed, digest of
    what is kept, and if asked for that text itself, as bytes (cuts may fall
    inside a character).

    A byte is removed if a string of `length` bytes over it also starts anywhere
    else in the input, in the same document too. Null and empty texts keep their
    nothing. Each row is a document, whatever its id: it may be null or shared by
    other rows, with the same text or not. Other columns are ignored; very
    long texts are searched in stretches that overlap; no rows give no rows.
    """
    rows = numbered_rows(docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")))
    docs = rows.select(F.col("row").alias("doc_id"), "text")
    scanned = stored(_scanned(docs, spec))
    sizes = scanned.select("doc_id", "n_bytes", "one", "two", "sha")
    same = stored(sizes.groupBy("one", "two").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")))
    wanted = _wanted(scanned, same.select(F.col("first").alias("doc_id")), spec)
    texts = written(packed_texts(docs).join(wanted, "doc_id"))
    covered = _sorted_spans(_segments(texts, spec), spec).unionAll(_hot_spans(texts, spec))
    spans = covered.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    cut = stored(_cut(texts.select("doc_id", "packed").join(spans, "doc_id"), with_text))

    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= spec.length)
    all_of_it = F.lit(hashlib.sha256(b"").hexdigest())
    found = (
        sizes.join(same, ["one", "two"])
        .select("doc_id", "n_bytes", "sha", copied.alias("copied"))
        .join(cut, "doc_id", "left")
    )
    removed = F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0)))
    count = F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("count", F.lit(0)))
    kept = F.when(F.col("copied"), all_of_it).otherwise(F.coalesce("kept", "sha"))
    found = found.join(rows.select(F.col("row").alias("doc_id"), "id"), "doc_id")
    columns = [F.col("id").alias(key), "n_bytes", removed.cast("long").alias("n_removed")]
    columns += [count.cast("long").alias("n_spans"), kept.alias("kept_sha256")]
    if not with_text:
        return found.select(*columns)
    whole = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("whole"))
    left = F.when(F.col("copied"), F.lit(b"")).otherwise(F.coalesce("rest", "whole"))
    return found.join(whole, "doc_id").select(*columns, left.alias("kept_bytes"))


def _cut(texts: DataFrame, with_text: bool) -> DataFrame:
    """What stays of each text without its spans."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, data, spans in unpacked(batch):
            parts, at, removed, count = [], 0, 0, 0
            for low, high in _united([(s["low"], s["high"]) for s in spans]):
                parts.append(data[at:low])
                count += 1
                removed += high - low
                at = high
            rest = b"".join([*parts, data[at:]])
            rows.append((doc, removed, count, hashlib.sha256(rest).hexdigest(), rest if with_text else None))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
            ["doc_id", "removed", "count", "kept", "rest"],
        )

    return in_batches(texts, step, "doc_id long, removed long, count long, kept string, rest binary", rows=64)
