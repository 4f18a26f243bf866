"""Source mixing and packing: targets, nearness, and whole packings."""

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from reachbook.llm.mixing import mix_sources
from reachbook.llm.packing import Encoder, Places, Vocabulary, cut, pack, pieces, plan, sequences
from tests.llm.helpers import documents, edge_rows, prose


def expected_targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """Give out what is left by weight, stop at the limit, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), share * sum(sizes.values()), list(order)
    while left > 1e-9 and open_:
        total, given = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            part = min(left * weight[s] / total, most * sizes[s] - target[s])
            target[s] += part
            given += part
            if target[s] >= most * sizes[s] - 1e-9:
                open_.remove(s)
        left -= given
    return target


def source_rows(seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    names = ["b", "a", "é", None, "Z", "", "hot"]
    rows = []
    for i in range(260):
        name = "hot" if rng.random() < 0.35 else names[int(rng.integers(0, len(names) - 1))]
        rows.append((i, prose(i, int(rng.integers(0, 40))) if i % 40 else None, "en", name))
    rows[7] = (7, prose(7, 900), "en", "a")
    return rows


@pytest.mark.parametrize(("seed", "buckets"), [(1, 4096), (2, 3)])
def test_mix(spark, seed, buckets):
    rows = source_rows(seed)
    found = mix_sources(documents(spark, rows), buckets=buckets).collect()
    source = {doc: s for doc, _, _, s in rows}
    sizes = Counter()
    for doc, text, _, s in rows:
        sizes[s] += len((text or "").split())
    wanted = expected_targets(sizes)
    taken, most_open = Counter(), {}
    assert len(found) == len(rows)
    for r in found:
        s = source[r.doc_id]
        assert r.source_size == sizes[s]
        assert np.isclose(r.target, wanted[s])
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.copies * r.size
        taken[s] += r.taken
        if 0 < r.copies < 2 or r.copies == 0:
            most_open[s] = max(most_open.get(s, 0), r.size)
    for s, target in wanted.items():
        assert abs(taken[s] - target) <= max(3, 0.03 * target), (s, taken[s], target)
    again = mix_sources(documents(spark, rows[::-1]).repartition(5), buckets=buckets).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, found), key=str)


def test_mix_prefers_longer_documents_and_follows_the_seed(spark):
    rows = [(i, prose(i, 4 if i % 2 else 36), "en", "a") for i in range(300)]
    rows += [(1000 + i, prose(i, 20), "en", "b") for i in range(900)]
    draws = [{r.doc_id: r.copies for r in mix_sources(documents(spark, rows), weights=(1, 9), seed=s).collect()} for s in (1, 2)]
    share = [np.mean([draws[0][i] for i in range(300) if (i % 2 == 0) == long]) for long in (True, False)]
    assert share[0] > 1.5 * share[1] > 0
    assert draws[0] != draws[1]


# Packing.


def test_cut():
    assert cut(5, 8) == [(0, 5)] and cut(8, 8) == [(0, 8)]
    assert cut(9, 8) == [(0, 1), (1, 8)] and cut(24, 8) == [(0, 8), (8, 8), (16, 8)]


@pytest.mark.parametrize("seed", range(25))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.choice([8, 30, 100]))
    counts = {int(n): int(rng.integers(1, 400)) for n in rng.choice(np.arange(1, size + 1), int(rng.integers(1, size)), replace=False)}
    packed = plan(counts, size)
    used = Counter()
    for bins in packed:
        assert bins.count > 0 and bins.gap(size) >= 0
        for length, times in bins.content:
            used[length] += times * bins.count
    assert used == counts
    places = Places(packed)
    filled: dict[int, list] = {}
    for length, count in counts.items():
        sequence, offset = places(length, np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            filled.setdefault(s, []).append((o, length))
    assert sorted(filled) == list(range(places.sequences))
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size


def test_two_documents_take_the_place_of_one():
    # 6 + 3 leaves a gap of 1 that 2 + 2 closes.
    packed = plan({6: 1, 3: 1, 2: 2}, 10)
    assert sorted(map(tuple, packed[0].content)) == [(2, 1), (2, 1), (6, 1)]


def test_plans_are_tight():
    rng = np.random.default_rng(5)
    counts = Counter(np.minimum(1024, rng.lognormal(5.5, 1.0, 20_000).astype(int) + 1).tolist())
    packed = plan(counts, 1024)
    least = sum(n * c for n, c in counts.items()) / 1024
    assert sum(b.count for b in packed) < 1.01 * least + 1


def test_ids_are_those_of_the_tokenizer():
    vocabulary = Vocabulary()
    encoder = Encoder(vocabulary)
    slow = Tokenizer.from_file(vocabulary.tokenizer)
    texts = [prose(1, 300), "", " ", "é ü ß ñ 漢字 \U0001f600‍", "a" * 5000, " " * 5000 + "x", "don't\n\n\tit's 123,456.7", "<|endoftext|> x",
             "hello <|endoftext|> world", "<|endoftext|>" * 3, "<|endoftext", "<|endoftext|> " + "a" * 5000,
             "\x85  z", "x\r\n  y"]
    for text in texts:
        assert encoder(text) == slow.encode(text, add_special_tokens=False).ids, repr(text[:30])


def test_equal_pieces_are_numbered_in_many_parts(spark):
    rows = [(1, "same text of every row")] * 3000
    found = pack(pieces(documents(spark, rows).repartition(3)), part_rows=100)
    assert found.select("sequence_id", "offset").distinct().count() == 3000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64(monotonically_increasing_id()" in plan


def test_packed_documents_round_trip(spark):
    size = 32
    rows = [(i, prose(i, i % 37)) for i in range(80)] + [(500, None), (501, ""), (502, prose(9, 200)), (502, prose(9, 200))]
    found = pack(pieces(documents(spark, rows), size=size, with_ids=True), size=size, part_rows=3)
    whole = {r.sequence_id: list(r.ids) for r in sequences(found).collect()}
    encoder = Encoder(Vocabulary())
    found = found.collect()
    filled = Counter()
    parts: dict = {}
    for r in found:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == list(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        filled[r.sequence_id] += r.length
        parts.setdefault(r.doc_id, Counter())[r.piece, r.start, r.length] += 1
    assert all(len(whole[s]) == n <= size for s, n in filled.items())
    for doc, text in rows:
        ids = [*encoder(text or ""), 2]
        times = sum(d == doc for d, _ in rows)
        assert parts[doc] == Counter({(i, s, n): times for i, (s, n) in enumerate(cut(len(ids), size))})
    assert len(filled) <= 1.05 * sum(filled.values()) / size + 1


@pytest.mark.parametrize("operator", [mix_sources, lambda d: pack(pieces(d))])
def test_edges(spark, operator):
    docs = documents(spark, edge_rows())
    found = operator(docs).collect()
    assert {str(r.doc_id) for r in found} == {str(r[0]) for r in edge_rows()}
    assert operator(docs.limit(0)).collect() == []
