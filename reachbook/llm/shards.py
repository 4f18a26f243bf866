"""Parts of texts that ask sharded tables, and get values in the order asked.

Texts are gathered in parts. What a part asks for are sorted numbers, cut by
their ranges into shards; a shard answers each part with one value per number,
in the same order, so no number travels back. Rows are one per part and shard:
as the input grows, raise both sizes with the memory of an executor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.llm.common import written

PARTS = "part long, units long, ids array<long>, labels array<string>, sizes array<long>, packed binary"
_TYPES = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary())


def one_row(names: tuple[str, ...], types: tuple[pa.DataType, ...], values: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], list(names))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows one by one, so no more than one large value is copied at a time."""
    for batch in batches:
        for start in range(batch.num_rows):
            yield tuple(c[0] for c in (x.to_pylist() for x in batch.slice(start, 1).columns))


@dataclass
class Part:
    """Some texts as UTF-8, with the id and label of each."""

    part: int
    ids: list[int | None]
    labels: list[str | None]
    sizes: list[int]
    packed: bytes

    def texts(self) -> Iterator[bytes]:
        data = zstandard.ZstdDecompressor().decompress(self.packed) if self.sizes else b""
        at = 0
        for size in self.sizes:
            yield data[at : at + size]
            at += size


def gathered(each: DataFrame, units: Callable[[bytes], int], size: int) -> DataFrame:
    """Rows of (id, label, text) in parts of about `size` bytes, written down: a
    part's number is drawn, and what was drawn must not be drawn again. `units`
    is how much a text may ask for. A text is never split; null is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw, packer = np.random.default_rng(), zstandard.ZstdCompressor(level=3)
        names = tuple(c.split()[0] for c in PARTS.split(", "))
        held: list[tuple] = []
        total = asks = 0

        def finished() -> pa.RecordBatch:
            ids, labels, texts = zip(*held, strict=True)
            packed = packer.compress(b"".join(texts))
            values = (int(draw.integers(1 << 62)), asks, ids, labels, [len(t) for t in texts], packed)
            return one_row(names, _TYPES, values)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for one, label, text in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                    text = text or b""
                    held.append((one, label, text))
                    total += len(text) + 1
                    asks += units(text)
                    if total >= size:
                        yield finished()
                        held, total, asks = [], 0, 0
        if held:
            yield finished()

    own = each.select(F.col("id").cast("long"), F.col("label").cast("string"), F.col("text").cast("string").cast("binary"))
    return written(own.mapInArrow(run, PARTS))


def shards_for(parts: DataFrame, each: int) -> int:
    """How many shards of about `each` units the parts need."""
    units = parts.agg(F.sum("units")).first()[0] or 0
    return max(1, -(-units // each))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each hash: its range of the high 32 bits, so hashes in order
    have their shards in order."""
    return (hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)


def runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Equal values that follow each other: value, first place, place after the last."""
    if len(values):
        starts = np.flatnonzero(np.concatenate([np.ones(1, bool), values[1:] != values[:-1]])).tolist()
        for start, end in zip(starts, [*starts[1:], len(values)], strict=True):
            yield int(values[start]), start, end


def pack_numbers(values: np.ndarray, ordered: bool = False) -> bytes:
    """Unsigned numbers, as differences if they are in order; bytes of equal
    weight lie together, so those that are always zero cost next to nothing."""
    if ordered and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(packed: bytes, kind: type, ordered: bool = False) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    width = np.dtype(kind).itemsize
    values = np.ascontiguousarray(data.reshape(width, -1).T).view(kind).reshape(-1)
    return np.cumsum(values, dtype=kind) if ordered else values
