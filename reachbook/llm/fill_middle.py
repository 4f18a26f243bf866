"""Fill-in-the-middle transformation of documents.

A text is cut after two drawn counts of tokens and its middle is moved to the
end, behind marks. Where a cut lies is found without tokenising the text: a
rolling hash cuts it into chunks that depend on content alone, so passages that
documents share are the same chunks; what a chunk adds to the counts is kept
under its hash and used again wherever its bytes return. Counts of chunks are
combined at their borders, and only the two chunks that hold a cut are searched.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachbook.llm.common import SPACE, in_batches

PLAIN, PSM, SPM = "plain", "psm", "spm"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Infill:
    """Marks of prefix, suffix and middle; the seed of the draws; how many of a
    hundred texts stay plain, and how many of a hundred others have their suffix
    first. No mark may begin with the end of another one or of itself, or an output
    could be read in two ways. Chunks have `least` to `most` bytes and end on average `1 << bits`
    bytes after the least; their counts are kept up to `memory` bytes of chunks."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: int = 42
    plain_percent: int = 50
    spm_percent: int = 80
    bits: int = 10
    least: int = 256
    most: int = 8192
    memory: int = 1 << 25

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


#: One random number per byte for the rolling hash.
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Bytes that a rolling hash looks back.
_WINDOW = 32
_STRETCH = 1 << 20


def _ends(data: bytes, bits: int) -> np.ndarray:
    """Places behind bytes at which the hash of the last 32 bytes ends in zeros."""
    found = []
    for start in range(0, len(data), _STRETCH):
        first = max(0, start - _WINDOW + 1)
        hashes = _GEAR[np.frombuffer(data, np.uint8, min(len(data), start + _STRETCH) - first, first)]
        reach = 1
        while reach < _WINDOW:
            # What is known of `reach` bytes, before that of as many earlier ones.
            hashes[reach:] += hashes[:-reach] << np.uint32(reach)
            reach *= 2
        # The high bits depend on the whole window.
        found.append(np.flatnonzero((hashes >> np.uint32(32 - bits))[start - first :] == 0) + start + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_ends(data: bytes, how: Infill) -> list[int]:
    """Where the chunks of a text end, the last one at its end."""
    out: list[int] = []
    last = 0
    for end in [*_ends(data, how.bits).tolist(), len(data)]:
        while end - last > how.most:
            last += how.most
            out.append(last)
        if end - last >= how.least:
            out.append(end)
            last = end
    if last < len(data):
        out.append(len(data))
    return out


class Summary(NamedTuple):
    """What a chunk adds to counts: code points, runs of word characters, and
    whether a word crosses its borders if its neighbour has the same to say."""

    chars: int
    runs: int
    from_word: bool
    to_word: bool


def chars(data: bytes) -> int:
    """Code points: all bytes of UTF-8 but those that continue one."""
    if data.isascii():
        return len(data)
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def summary(chunk: bytes) -> Summary:
    return Summary(chars(chunk), len(chunk.split()), chunk[0] not in SPACE, chunk[-1] not in SPACE)


class Memo:
    """Summaries of chunks by hash. A chunk counts as known only if its bytes are
    those kept under the hash. Full, it forgets the chunks not met since it was
    last half full, so memory is bounded and a result never depends on it."""

    def __init__(self, memory: int):
        self.half = memory // 2
        self.young: dict[int, tuple[bytes, Summary]] = {}
        self.old: dict[int, tuple[bytes, Summary]] = {}
        self.held = self.hits = self.misses = 0

    def __call__(self, chunk: bytes) -> Summary:
        at = xxhash.xxh3_64_intdigest(chunk)
        known = self.young.get(at)
        if known is not None and known[0] == chunk:
            self.hits += 1
            return known[1]
        known = self.old.get(at)
        if known is not None and known[0] == chunk:
            self.hits += 1
        else:
            self.misses += 1
            known = chunk, summary(chunk)
        if self.held + len(chunk) > self.half:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[at] = known
        self.held += len(chunk)
        return known[1]


class Counted:
    """A text's tokens, by its chunks. A token is a word with the blanks before
    it, or the blanks at the end of the text."""

    def __init__(self, data: bytes, how: Infill, memo: Memo):
        self.data = data
        ends = chunk_ends(data, how)
        self.starts = [0, *ends]
        found = [memo(data[a:b]) for a, b in zip(self.starts, ends, strict=False)]
        # A word ends in the chunk that holds its last character.
        goes_on = [a.to_word and b.from_word for a, b in zip(found, found[1:], strict=False)] + [False]
        self.words = list(accumulate((s.runs - on for s, on in zip(found, goes_on, strict=False)), initial=0))
        self.chars = list(accumulate((s.chars for s in found), initial=0))
        self.tokens = self.words[-1] + bool(found and not found[-1].to_word)

    def cut(self, tokens: int) -> tuple[int, int]:
        """Bytes and code points of the first `tokens` tokens."""
        if tokens == self.tokens:
            return len(self.data), self.chars[-1]
        if not tokens:
            return 0, 0
        chunk = bisect_left(self.words, tokens) - 1
        start, end = self.starts[chunk : chunk + 2]
        word = next(islice(_WORD.finditer(self.data, start, end), tokens - self.words[chunk] - 1, None))
        return word.end(), self.chars[chunk] + chars(self.data[start : word.end()])


class Filled(NamedTuple):
    tokens: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def fill(data: bytes, key: int | None, how: Infill, memo: Memo) -> Filled:
    """One text transformed by the draws of its key."""
    counted = Counted(data, how, memo)
    digest = hashlib.sha256(f"{how.seed}:{'' if key is None else key}".encode()).hexdigest()
    first, second, whether, which = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    marks = [m.encode() for m in how.marks]
    if not data or any(m in data for m in marks) or whether % 100 >= 100 - how.plain_percent:
        return Filled(counted.tokens, PLAIN, None, None, data)
    drawn = sorted((first % (counted.tokens + 1), second % (counted.tokens + 1)))
    (a, a_chars), (b, b_chars) = map(counted.cut, drawn)
    prefix, middle, suffix = marks[0] + data[:a], marks[2] + data[a:b], marks[1] + data[b:]
    form = SPM if which % 100 < how.spm_percent else PSM
    parts = (suffix, prefix, middle) if form == SPM else (prefix, suffix, middle)
    return Filled(counted.tokens, form, a_chars, b_chars - a_chars, b"".join(parts))


def fill_middle(docs: DataFrame, *, how: Infill = Infill(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its tokens `n`, its form, the code points of prefix
    and middle (null if plain), and the output.

    A null text is empty, and an empty one stays plain, like one that holds a
    mark. The draws depend on the seed and the key alone: repeated rows are cut
    alike, a null key draws like an empty one. Very long texts are cut whole;
    other columns are ignored; no rows give no rows.
    """
    held: list[Memo] = []
    names = (key, "n", "form", "prefix_chars", "middle_chars", "output")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Memo(how.memory))
        keys, texts = (c.to_pylist() for c in batch.columns)
        found = [fill(t or b"", k, how, held[0]) for k, t in zip(keys, texts, strict=True)]
        columns = [keys, *zip(*found, strict=True)]
        arrays = [pa.array(c, t) for c, t in zip(columns[:-1], types[:-1], strict=True)]
        output = pa.array(columns[-1], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([*arrays, output], names)

    own = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").cast("binary").alias("text"))
    return in_batches(own, step, f"{key} long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: str = "form", output: str = "output", how: Infill = Infill()) -> Column:
    """The text that an output was made of, from its form and its marks."""
    cuts = "|".join(re.escape(m) for m in how.marks)
    parts = F.split(output, cuts, -1)
    first, second, last = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(F.col(form) == PSM, F.concat(first, last, second))
        .when(F.col(form) == SPM, F.concat(second, last, first))
        .otherwise(F.col(output))
    )
