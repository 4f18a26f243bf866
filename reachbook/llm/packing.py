"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Only lengths matter to a packing, and there are no more of them than a sequence
has tokens. So the plan is made from how many pieces there are of each length:
bins that are filled alike are one pattern with a multiplicity, whatever the
corpus holds. Pieces are then numbered per length, in parts, and look up the
place of their number.
"""

from __future__ import annotations

import base64
import zlib
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reachbook.llm.common import in_batches, stored

#: Unbroken runs from this length on go to the library that never takes long over them.
LONG_RUN = 2048


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level vocabulary: its `tokenizers` file, and the same as ranks,
    which gives the same ids faster. `end` closes every document."""

    tokenizer: str = public_tokenizers.path("byte_bpe_50k.json")
    ranks: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN
    end: int = 2


def special_tokens(vocabulary: Vocabulary) -> tuple[str, ...]:
    """Strings that are a token of their own wherever they are. Looked up once, on
    the driver: loading the file takes an executor's workers more than the ranks do."""
    return tuple(t.content for t in Tokenizer.from_file(vocabulary.tokenizer).get_added_tokens_decoder().values())


class Encoder:
    """Ids of texts, as the vocabulary's `tokenizers` file gives them: the string
    of a special token is that token."""

    def __init__(self, vocabulary: Vocabulary, added: tuple[str, ...] | None = None):
        self.vocabulary = vocabulary
        self.added = special_tokens(vocabulary) if added is None else added
        with open(vocabulary.ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
        self.steady: Tokenizer | None = None

    def __call__(self, text: str) -> list[int]:
        words = text.split()
        longest = max(map(len, words), default=0)
        blanks = len(text) - sum(map(len, words)) - len(words)
        if longest < LONG_RUN and blanks < LONG_RUN and not any(t in text for t in self.added):
            return self.fast.encode_ordinary(text)
        if self.steady is None:
            self.steady = Tokenizer.from_file(self.vocabulary.tokenizer)
        return self.steady.encode(text, add_special_tokens=False).ids


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens; only the first one may be shorter."""
    first = n % size or size
    starts = [0, *range(first, n, size)] if n > size else [0]
    return [(s, (e - s)) for s, e in zip(starts, [*starts[1:], n], strict=True)]


def pieces(
    docs: DataFrame,
    *,
    size: int = 1024,
    vocabulary: Vocabulary = Vocabulary(),
    with_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per piece of a document: number, start, length, checksum, and its ids if asked for.

    A null text is empty, and an empty one is its end mark. Repeated rows give
    repeated pieces; other columns are ignored; no rows give no rows.
    """
    held: list[Encoder] = []
    added = special_tokens(vocabulary)
    names = [key, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * with_ids]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Encoder(vocabulary, added))
        rows = []
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.array([*held[0](value or ""), vocabulary.end], "<u4")
            for number, (start, length) in enumerate(cut(len(ids), size)):
                own = ids[start : start + length]
                rows.append((doc, number, start, length, zlib.crc32(own.tobytes()), *[own] * with_ids))
        columns = zip(*rows, strict=True)
        arrays = [pa.array([list(x) for x in c] if n == "ids" else c, t) for n, c, t in zip(names, columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    schema = f"{key} long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return in_batches(docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("text")), step, schema)


@dataclass
class Bins:
    """Bins filled alike: how many, and (length, repeats) in order, longest first."""

    count: int
    content: list[list[int]]

    def gap(self, size: int) -> int:
        return size - sum(length * times for length, times in self.content)

    def split(self, count: int) -> Bins:
        """Take some of the bins away, to be filled differently."""
        self.count -= count
        return Bins(count, [list(x) for x in self.content])

    def add(self, length: int, times: int = 1) -> None:
        self.content.append([length, times])

    def drop_smallest(self) -> int:
        last = min(self.content, key=lambda x: x[0])
        last[1] -= 1
        if not last[1]:
            self.content.remove(last)
        return last[0]


def plan(counts: dict[int, int], size: int) -> list[Bins]:
    """Pack pieces, given how many there are of each length.

    The longest piece left opens a bin, which takes the longest piece that fits
    until none does. Then its smallest piece makes room for two unpacked ones
    that fill the gap further, as long as there are such two.
    """
    left = np.zeros(size + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    done: list[Bins] = []
    for longest in range(size, 0, -1):
        while left[longest]:
            open_bins = [Bins(int(left[longest]), [[longest, 1]])]
            left[longest] = 0
            while open_bins:
                bins = open_bins.pop()
                if not (_fill(bins, left, size, open_bins) or _two_fit(bins, left, size, open_bins)):
                    done.append(bins)
                else:
                    open_bins.append(bins)
    return done


def _longest_up_to(left: np.ndarray) -> np.ndarray:
    """Per length, the longest one not above it that is left, or 0."""
    return np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))


def _fill(bins: Bins, left: np.ndarray, size: int, others: list[Bins]) -> bool:
    gap = bins.gap(size)
    fits = np.flatnonzero(left[: gap + 1])
    if not len(fits):
        return False
    length = int(fits[-1])
    if left[length] < bins.count:
        others.append(bins.split(bins.count - int(left[length])))
    times = min(gap // length, int(left[length]) // bins.count)
    bins.add(length, times)
    left[length] -= times * bins.count
    return True


def _two_fit(bins: Bins, left: np.ndarray, size: int, others: list[Bins]) -> bool:
    gap = bins.gap(size)
    if not gap or sum(times for _, times in bins.content) < 2:
        return False
    smallest = min(length for length, _ in bins.content)
    room = gap + smallest
    below = _longest_up_to(left)
    one = np.flatnonzero(left[: room + 1])
    if not len(one):
        return False
    two = below[room - one]
    # The last piece of its length cannot be taken twice.
    single = (two == one) & (left[one] == 1)
    two[single] = below[one[single] - 1]
    sums = np.where(two > 0, one + two, 0)
    best = int(np.argmax(sums))
    if sums[best] <= smallest:
        return False
    a, b = int(one[best]), int(two[best])
    possible = int(left[a]) // 2 if a == b else int(min(left[a], left[b]))
    if possible < bins.count:
        others.append(bins.split(bins.count - possible))
    left[a] -= bins.count
    left[b] -= bins.count
    left[bins.drop_smallest()] += bins.count
    bins.add(max(a, b))
    bins.add(min(a, b))
    return True


class Places:
    """Where the n-th piece of a length goes: sequence and offset."""

    def __init__(self, packed: list[Bins]):
        slots: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        sequence = 0
        for bins in packed:
            offset = 0
            for length, times in bins.content:
                slots.setdefault(length, []).append((used.get(length, 0), sequence, times, offset))
                used[length] = used.get(length, 0) + times * bins.count
                offset += length * times
            sequence += bins.count
        self.sequences = sequence
        self.slots = {length: np.array(own, np.int64) for length, own in slots.items()}

    def __call__(self, length: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = self.slots[length]
        first, sequence, times, offset = own[np.searchsorted(own[:, 0], numbers, side="right") - 1].T
        return sequence + (numbers - first) // times, offset + (numbers - first) % times * length


def pack(found: DataFrame, *, size: int = 1024, part_rows: int = 5000) -> DataFrame:
    """The pieces with their sequence and their offset in it.

    Pieces of one length are numbered in parts of about `part_rows`, so a length
    that a third of all pieces have is shared out. The driver sees one count per
    length. Repeated pieces each get a place; no pieces give no rows.
    """
    found = stored(found)
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    places = Places(plan(counts, size))
    parts = F.array(*[F.lit(-(-counts.get(length, 1) // part_rows)) for length in range(size + 1)])
    order = [c for c in found.columns if c != "ids"]
    # By the number of the row, which the checkpoint fixes: equal rows are shared out too.
    drawn = F.xxhash64(F.monotonically_increasing_id())
    dealt = found.withColumn("_part", F.pmod(drawn, F.get(parts, F.col("length"))))
    starts = dealt.groupBy("length", "_part").count().withColumn(
        "_before", F.sum("count").over(Window.partitionBy("length").orderBy("_part")) - F.col("count")
    )
    within = F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order)) - 1
    numbered = dealt.withColumn("_within", within).join(starts.drop("count"), ["length", "_part"])
    numbered = numbered.select(*found.columns, (F.col("_before") + F.col("_within")).alias("_number"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, numbers = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_number"))
        sequence, offset = np.empty_like(numbers), np.empty_like(numbers)
        for length in np.unique(lengths):
            here = lengths == length
            sequence[here], offset[here] = places(int(length), numbers[here])
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"]
        )

    schema = ", ".join([*[f"`{n}` {t}" for n, t in found.dtypes], "sequence_id long", "offset long"])
    return in_batches(numbered, step, schema, rows=10_000)


def sequences(packed: DataFrame) -> DataFrame:
    """Training sequences, from pieces packed with their ids: one row each."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(own, lambda x: x["ids"])).alias("ids"))
