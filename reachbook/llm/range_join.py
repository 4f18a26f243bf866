"""Exact range join of embeddings in a metric space.

Unit vectors with cosine c are sqrt(2 - 2c) apart, so a least cosine is a
greatest distance r. Every vector belongs to the cell of its nearest pivot. By
the triangle inequality a vector within r of a cell's vectors is at most 2r
farther from that cell's pivot than from its own; in Euclidean space the plane
between the two pivots bounds it closer, by r. Vectors that near a border are
copied to the cell across it, so each cell finds its vectors' partners alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.llm.common import components, in_batches, stored


@dataclass(frozen=True)
class Range:
    """`least` cosine of a link. At most `pivots` pivots, one per `per_pivot`
    vectors, are drawn by hash; how many there are never changes the links. A
    cell's own vectors are compared in blocks of about `block`."""

    least: float = 0.9
    pivots: int = 64
    per_pivot: int = 4000
    block: int = 6000

    @property
    def radius(self) -> float:
        # Rounding must not lose a copy.
        return math.sqrt(2.0 - 2.0 * self.least) + 1e-9


def _unit(values: np.ndarray) -> np.ndarray:
    # The largest component first: squares of huge ones overflow, of tiny ones vanish.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _clean(vectors: DataFrame, key: str, embedding: str) -> tuple[DataFrame, DataFrame]:
    """All ids, and the vectors that can link: with an id, neither null, empty
    nor zero, all components finite."""
    each = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return each.select("id"), each.where(F.col("id").isNotNull() & F.coalesce(finite & some, F.lit(False)))


def _pivots(distinct: DataFrame, spec: Range) -> np.ndarray:
    """Pivots drawn by the hash of their vector: a bounded number of rows."""
    count = distinct.count()
    wanted = max(1, min(spec.pivots, count // spec.per_pivot))
    rows = distinct.orderBy(F.xxhash64("vector"), "id").limit(wanted).select("vector").collect()
    return _unit(np.array([r[0] for r in rows]))


def _cells(batch_vectors: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest pivot of each vector; and row and cell of each copy across a border."""
    dots = batch_vectors @ pivots.T
    own = dots.argmax(axis=1)
    gaps = np.linalg.norm(pivots[own][:, None, :] - pivots[None, :, :], axis=2)
    behind = dots[np.arange(len(own)), own][:, None] - dots
    # Equal pivots have no plane between them: keep the copy.
    near = behind <= radius * gaps + 1e-9
    near[np.arange(len(own)), own] = False
    return own, *np.nonzero(near)


def _dealt(distinct: DataFrame, pivots: np.ndarray, spec: Range) -> DataFrame:
    """(cell, block, own, id, copies, vector): each vector once in a block of its
    cell as its own, and once for every block whose vectors it is compared with."""
    radius = spec.radius

    def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = _matrix(batch.column(batch.schema.get_field_index("vector")))
        own, _, _ = _cells(_unit(values), pivots, radius)
        return batch.append_column("cell", pa.array(own.astype(np.int32)))

    placed = stored(in_batches(distinct, assign, "id long, vector array<double>, copies long, cell int", rows=2048))
    # One row per pivot.
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    blocks = np.array([max(1, -(-sizes.get(c, 0) // spec.block)) for c in range(len(pivots))])
    filled = np.array([sizes.get(c, 0) > 0 for c in range(len(pivots))])
    names = ["cell", "block", "own", "id", "copies", "vector"]

    def copy(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, vectors, copies = (batch.column(batch.schema.get_field_index(n)) for n in ("id", "vector", "copies"))
        unit = _unit(_matrix(vectors))
        own, rows, cells = _cells(unit, pivots, radius)
        number = ids.to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        home = (number % blocks[own].astype(np.uint64)).astype(np.int64)
        across = filled[cells]
        rows = np.concatenate([np.arange(len(own)), rows[across]])
        cells = np.concatenate([own, cells[across]])
        # Once per block of the cell.
        times = blocks[cells]
        rows, cells = np.repeat(rows, times), np.repeat(cells, times)
        block = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
        mine = (cells == own[rows]) & (block == home[rows])
        width = unit.shape[1]
        values = pa.FixedSizeListArray.from_arrays(pa.array(unit[rows].ravel()), width).cast(pa.list_(pa.float64()))
        taken = pa.array(rows)
        columns = [pa.array(cells.astype(np.int32)), pa.array(block.astype(np.int32)), pa.array(mine)]
        return pa.RecordBatch.from_arrays([*columns, ids.take(taken), copies.take(taken), values], names)

    schema = "cell int, block int, own boolean, id long, copies long, vector array<double>"
    return in_batches(placed, copy, schema, rows=512)


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


class Block:
    """The own vectors of one block, their links so far and what those join."""

    def __init__(self, least: float):
        self.least = least
        self.ids, self.vectors = [], []
        self.matrix: np.ndarray | None = None

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids.append(ids)
        self.vectors.append(vectors)

    def close(self) -> None:
        if self.matrix is None:
            self.id = np.concatenate(self.ids)
            self.matrix = np.concatenate(self.vectors)
            self.links = np.zeros(len(self.id), np.int64)
            self.parent = np.arange(len(self.id))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def compare(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[int, int]]:
        """Count links of the own vectors with these. Yields one link per vector
        here that has any; the others join own vectors through it."""
        self.close()
        near = vectors @ self.matrix.T >= self.least
        self.links += copies @ near
        for row in np.flatnonzero(near.any(axis=1)):
            linked = np.flatnonzero(near[row])
            first = self.root(int(linked[0]))
            for other in linked[1:].tolist():
                two = self.root(other)
                if two != first:
                    self.parent[max(first, two)] = min(first, two)
                    first = min(first, two)
            yield int(ids[row]), int(self.id[linked[0]])

    def joined(self) -> Iterator[tuple[int, int]]:
        self.close()
        for i in range(len(self.id)):
            root = self.root(i)
            if root != i:
                yield int(self.id[root]), int(self.id[i])


def _compared(dealt: DataFrame, least: float) -> DataFrame:
    """(id, links, a, b): an own vector's number of links, or a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, links = None, None, []

        def out() -> pa.RecordBatch:
            count = len(block.id) if block and block.matrix is not None else 0
            extra = list(block.joined()) if count else []
            edges = np.array(links + extra, np.int64).reshape(-1, 2)
            edges = edges[edges[:, 0] != edges[:, 1]]
            none = pa.nulls(len(edges), pa.int64())
            blank = pa.nulls(count, pa.int64())
            both = [
                (pa.array(block.id), none) if count else (blank, none),
                (pa.array(block.links), none) if count else (blank, none),
                (blank, pa.array(edges[:, 0])),
                (blank, pa.array(edges[:, 1])),
            ]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in both], ["id", "links", "a", "b"])

        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                cell, part = (batch.column(i).to_numpy() for i in (0, 1))
                own = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
                ids, copies, vectors = batch.column(3).to_numpy(), batch.column(4).to_numpy(), _matrix(batch.column(5))
                place = cell.astype(np.int64) << 32 | part
                turns = np.flatnonzero(np.diff(place)) + 1
                for low, high in zip([0, *turns], [*turns, len(place)], strict=True):
                    if place[low] != at:
                        if block and block.ids:
                            block.close()
                            yield out()
                        at, block, links = place[low], Block(least), []
                    mine = own[low:high]
                    if mine.any():
                        block.add(ids[low:high][mine], vectors[low:high][mine])
                    if not mine.all() and block.ids:
                        other = ~mine
                        links += block.compare(ids[low:high][other], copies[low:high][other], vectors[low:high][other])
        if block and block.ids:
            block.close()
            yield out()

    return dealt.mapInArrow(run, "id long, links long, a long, b long")


def range_join(vectors: DataFrame, spec: Range = Range(), *, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector: n_links, component_id and whether it stays (kept).

    Vectors without an id, and those that are null, empty or zero or hold null or
    non-finite components, link with nothing; nor do vectors of different lengths, each of which takes a
    round of its own. Finite vectors of any length, huge or tiny, have their
    direction's links. Equal vectors are compared once and counted as often as
    they occur. Repeated rows count as vectors of their own and share a result;
    other columns are ignored; no rows give no rows.
    """
    every, clean = _clean(vectors, key, embedding)
    clean = stored(clean)
    widths = [r["width"] for r in clean.select(F.size("vector").alias("width")).distinct().collect()]
    results = [_of_width(clean.where(F.size("vector") == w), spec) for w in sorted(widths)]
    found = clean.select("id").limit(0).select("id", F.lit(0).cast("long").alias("n_links"), "id")
    found = found.toDF("id", "n_links", "component_id")
    for own in results:
        found = found.unionByName(own)
    found = found.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return every.join(stored(found), "id", "left").select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        (F.coalesce("component_id", "id") == F.col("id")).alias("kept"),
    )


def _of_width(clean: DataFrame, spec: Range) -> DataFrame:
    """(id, n_links, component_id) of vectors of one length."""
    distinct = stored(clean.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    distinct = distinct.select("id", "vector", "copies")
    pivots = _pivots(distinct, spec)
    # A block's own vectors come first, and all of it is compared with them: each own vector comes twice.
    dealt = _dealt(distinct, pivots, spec)
    again = dealt.where("own").withColumn("own", F.lit(False))
    sorted_ = dealt.unionAll(again).repartition("cell", "block").sortWithinPartitions("cell", "block", F.desc("own"), "id")
    found = stored(_compared(sorted_, spec.least))
    groups = components(found.where("a is not null").select("a", "b"))
    of_rep = (
        found.where("id is not null")
        .groupBy("id")
        .agg((F.sum("links") - 1).alias("n_links"))
        .join(groups, "id", "left")
        .select(F.col("id").alias("rep"), "n_links", F.coalesce("component", "id").alias("component_id"))
    )
    copies = clean.join(distinct.select("vector", F.col("id").alias("rep")), "vector").select("id", "rep")
    return copies.join(stored(of_rep), "rep").select("id", "n_links", "component_id")
