"""Range join, n-gram join, repeated strings and components against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from reachbook.llm import jaccard
from reachbook.llm import suffix_dedup as sd
from reachbook.llm.common import components
from reachbook.llm.jaccard import Join, Sets, Signer, gram_set, jaccard_components
from reachbook.llm.range_join import Range, range_join
from reachbook.llm.suffix_dedup import Repeats, suffix_dedup
from tests.llm.helpers import by_id, documents, edge_rows, prose


class Groups:
    def __init__(self, ids):
        self.parent = {i: i for i in ids}

    def root(self, i):
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    pick = random.Random(seed)
    edges = [(pick.randrange(120), pick.randrange(120)) for _ in range(70)]
    edges += [(500 + i, 501 + i) for i in range(40)] + [(900, 901 + i) for i in range(30)]
    groups = Groups({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: groups.root(x) for x in linked}


def test_no_edges_give_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# Embeddings.


def vectors(seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(60)]
    for i in range(60, 110):  # near some of the others, about the border of 0.9
        rows.append((i, (np.array(rows[i % 20][1]) + rng.standard_normal(6) * rng.choice([0.05, 0.35])).tolist()))
    rows += [(110, rows[3][1]), (111, rows[3][1]), (112, (np.array(rows[4][1]) * 5).tolist())]
    odd = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] + [1.0] * 5, [float("inf")] + [1.0] * 5, [1.0, 2.0]]
    return rows + [(200 + i, v) for i, v in enumerate(odd)] + [(300, [2.0, 4.0])]


@pytest.mark.parametrize("spec", [Range(), Range(per_pivot=10, block=7), Range(least=0.6, pivots=5, per_pivot=3)])
def test_range_join_is_exact(spark, spec):
    rows = vectors(4)
    schema = "vec_id long, embedding array<double>, label int, cell int, id string"
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], schema)
    found = by_id(range_join(table, spec), "vec_id")
    groups, links = Groups([i for i, _ in rows]), Counter()
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    for n, (i, x) in enumerate(good):
        for j, y in good[:n]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= spec.least:
                links.update([i, j])
                groups.join(i, j)
    assert len(found) == len(rows)
    for i, _ in rows:
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (links[i], groups.root(i), groups.root(i) == i)


def test_range_join_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert range_join(empty).collect() == []
    nulls = spark.createDataFrame([(1, None), (1, None), (None, [1.0])], "vec_id long, embedding array<float>")
    assert len(range_join(nulls).collect()) == 3


# N-grams.


def shingles(text: str | None, k: int) -> frozenset:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def near_copies(seed: int) -> list[tuple]:
    """Families of texts with some words changed, copies, shared passages, short ones."""
    pick = random.Random(seed)
    passage = prose(77, 30)
    rows = []
    for family in range(14):
        words = prose(seed * 100 + family, pick.choice([3, 9, 12, 25, 60, 150])).split()
        for _ in range(pick.randrange(1, 9)):
            copy = list(words)
            for _ in range(pick.choice([0, 0, 1, 1, 2, 4])):
                copy[pick.randrange(len(copy))] = pick.choice(["x", "Y", "é", copy[0]])
            text = " ".join(copy[pick.choice([0, 0, 0, 1]) :])
            rows.append((text.upper() if pick.random() < 0.2 else text) + (f" {passage}" if pick.random() < 0.2 else ""))
    rows += ["a", "A", "a b", "a  b", "a b c", "a b a b a b", "É x y", "é x y", None, "", " \n"]
    pick.shuffle(rows)
    return [(1000 - 3 * i, text) for i, text in enumerate(rows)]


def expected_components(rows: list[tuple], join: Join) -> dict:
    sets = {doc: shingles(text, join.words) for doc, text in rows}
    groups = Groups(sets)
    for a, one in sets.items():
        for b, two in sets.items():
            if a < b and one and two and join.linked(len(one & two), len(one), len(two)):
                groups.join(a, b)
    return {doc: (len(s), groups.root(doc)) for doc, s in sets.items()}


@pytest.mark.parametrize(
    ("seed", "join"),
    [
        (1, Join()),
        (2, Join(block_rows=3, signs_at_once=200, common=40)),
        (3, Join(words=5, percent=80, block_rows=4, signs_at_once=500, common=500)),
        (4, Join(words=2, percent=50, common=0)),
    ],
)
def test_jaccard_components_are_exact(spark, seed, join):
    rows = near_copies(seed)
    found = by_id(jaccard_components(documents(spark, rows), join))
    assert {d: (r.n_grams, r.component_id) for d, r in found.items()} == expected_components(rows, join)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_a_signature(percent):
    """Whatever is common, and for sets of any size."""
    join = Join(percent=percent, spare=0)
    rng = np.random.default_rng(percent)
    misses = 0
    for trial in range(600):
        n = int(rng.integers(1, 120))
        one = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        two = one.copy()
        rng.shuffle(two)
        two = np.concatenate([two[int(rng.integers(0, max(1, n // 3))) :], rng.integers(0, 1 << 62, int(rng.integers(0, n // 3 + 1))).astype(np.uint64)])
        two = np.unique(two)
        shared = len(np.intersect1d(one, two))
        common = np.sort(rng.choice(one, int(rng.integers(0, len(one) + 1)), replace=False)) if trial % 2 else np.empty(0, np.uint64)
        signer = Signer(join, common)
        if join.linked(shared, len(one), len(two)) and not np.array_equal(one, two):
            misses += not np.intersect1d(signer(one), signer(two)).size
    assert misses == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_as_many_signatures_as_each_of_them_asks(percent):
    rng = np.random.default_rng(percent)
    least = []
    for trial in range(400):
        join = Join(percent=percent, spare=trial % 3)
        n = int(rng.integers(1, 400))
        one = np.unique(rng.integers(0, (1 << 64) - 1, n, np.uint64))
        two = one[rng.random(len(one)) > rng.random() * 0.4]
        two = np.unique(np.concatenate([two, rng.integers(0, (1 << 64) - 1, int(rng.integers(0, n // 5 + 1)), np.uint64)]))
        common = np.sort(rng.choice(one, len(one) // 3, replace=False)) if trial % 2 else np.empty(0, np.uint64)
        if join.linked(len(np.intersect1d(one, two)), len(one), len(two)) and not np.array_equal(one, two):
            (signs, asked), (others, also) = map(Signer(join, common).signed, (one, two))
            least.append(max(asked, also))
            assert len(np.intersect1d(signs, others)) >= least[-1]
    assert max(least) > 8


@pytest.mark.parametrize("few", [2, 3, 8])
@pytest.mark.parametrize("signs", [60, 300, 1 << 20])
def test_no_link_is_lost_whatever_many_share(spark, few, signs):
    rows = near_copies(5) + [(2000 + i, f"{prose(i, 40)} {prose(78, 25)}") for i in range(12)]
    rows += [(3000 + i, text) for i, (_, text) in enumerate(rows[::3])]
    join = Join(words=3, percent=80, few=few, signs_at_once=signs, common=30)
    docs = documents(spark, rows).repartition(5)
    found = by_id(jaccard_components(docs, join))
    assert {d: (r.n_grams, r.component_id) for d, r in found.items()} == expected_components(rows, join)


def test_sets_with_the_same_first_bits(spark, monkeypatch):
    """All sets go by one of four names among candidates; the names cost time, not links."""
    monkeypatch.setattr(jaccard, "VERTEX", 3)
    monkeypatch.setattr(jaccard, "_vertex", lambda grams: xxhash.xxh3_128_digest(grams.tobytes())[0] & 3)
    rows = near_copies(6)
    found = by_id(jaccard_components(documents(spark, rows), Join(percent=80)))
    assert {d: (r.n_grams, r.component_id) for d, r in found.items()} == expected_components(rows, Join(percent=80))


def test_shared_phrases_chain_no_groups(spark, monkeypatch):
    """Each text has a passage of the one before, and one that all of them have: no
    two are near copies, so none but the pair of near copies is sent to be compared."""
    sent = []
    links = jaccard._links

    def counted(docs, members, join):
        sent.append(members.agg(F.sum("blocks")).first()[0])
        return links(docs, members, join)

    monkeypatch.setattr(jaccard, "_links", counted)
    passages = [prose(500 + i, 14) for i in range(41)]
    rows = [(i, " ".join([prose(i, 130), passages[i], prose(99, 14), passages[i + 1]])) for i in range(40)]
    rows.append((90, rows[7][1] + " more"))
    join = Join(words=5, percent=80, common=0)
    found = by_id(jaccard_components(documents(spark, rows).repartition(4), join))
    assert {d: (r.n_grams, r.component_id) for d, r in found.items()} == expected_components(rows, join)
    assert sent == [2]


def test_copies_are_no_candidates(spark):
    """However many tasks hold them."""
    rows = [(i, prose(i % 5, 60)) for i in range(60)]
    docs = documents(spark, rows).repartition(6)
    assert jaccard._groups(jaccard._shared(docs, Join(), 3)).collect() == []
    assert {r.component_id for r in jaccard_components(docs).collect()} == set(range(5))


def test_overlaps_are_summed_over_fragments():
    join = Join()
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(0, 1 << 62, 60).astype(np.uint64)
        pair = [np.unique(rng.choice(pool, int(rng.integers(1, 60)))) for _ in range(2)]
        known = Sets([1, 2], pair, join)
        shared = len(np.intersect1d(*pair))
        assert known.similar(0, 1) == join.linked(shared, len(pair[0]), len(pair[1]))


def test_gram_set_folds_ascii_only():
    assert np.array_equal(gram_set(b"A b C", 3), gram_set(b"a\tB\nc", 3))
    assert not np.array_equal(gram_set("É x y".encode(), 3), gram_set("é x y".encode(), 3))
    assert len(gram_set(b" \n", 3)) == 0


# Repeated strings.


@pytest.mark.parametrize("compared", [3, 1 << 15])
def test_two_stage_sorts_suffixes(monkeypatch, compared):
    monkeypatch.setattr(sd, "COMPARED", compared)
    rng = np.random.default_rng(1)
    for _ in range(150):
        text = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(1, 70))).astype(np.uint8)
        data = text.tobytes()
        assert sd.two_stage(text, 80).tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def removed(texts: list[bytes], length: int) -> list[np.ndarray]:
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    masks = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                mask[i : i + length] = True
        masks.append(mask)
    return masks


def repeating_rows(seed: int) -> list[tuple]:
    pick = random.Random(seed)
    passages = [prose(i, 12) for i in range(4)]
    rows = []
    for i in range(45):
        parts = [prose(seed * 1000 + i * 10 + k, pick.randrange(15)) for k in range(3)]
        parts += pick.sample(passages, pick.randrange(3))
        parts += [pick.choice(["", "ab" * 40, "é" * 30, "xyz" * pick.randrange(30)])]
        pick.shuffle(parts)
        rows.append(" ".join(parts))
    rows += [rows[0], rows[0], rows[1] + rows[1], None, "", "short"]
    return [(7 * i % 101, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("spec", [Repeats(20, 8), Repeats(24, 9, hot=2, array_bytes=100), Repeats(30, 30, hot=5)])
def test_suffix_dedup_is_exact(spark, monkeypatch, spec):
    monkeypatch.setattr(sd, "STRETCH", 50)
    rows = repeating_rows(spec.length)
    found = by_id(suffix_dedup(documents(spark, rows), spec, with_text=True))
    texts = [(t or "").encode() for _, t in rows]
    for (doc, _), data, mask in zip(rows, texts, removed(texts, spec.length), strict=True):
        rest = np.frombuffer(data, np.uint8)[~mask].tobytes()
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        row = found[doc]
        assert (row.n_bytes, row.n_removed, row.n_spans) == (len(data), int(mask.sum()), spans)
        assert row.kept_sha256 == hashlib.sha256(rest).hexdigest()
        assert bytes(row.kept_bytes) == rest


def test_near_copies_whatever_their_ids(spark):
    base, other = prose(1, 60), prose(2, 60)
    rows = [(5, base), (None, base + " more"), (5, other), (3, other + " more"), (None, prose(3, 50)), (None, prose(3, 50) + " x"), (9, ""), (9, None)]
    found = [(r.doc_id, r.n_grams > 0, r.component_id) for r in jaccard_components(documents(spark, rows)).collect()]
    wanted = [(5, True, 5), (None, True, 5), (5, True, 3), (3, True, 3), (None, True, None), (None, True, None), (9, False, 9), (9, False, 9)]
    assert Counter(found) == Counter(wanted)


def test_shared_strings_whatever_the_ids(spark):
    shared = prose(9, 120)
    rows = [(5, prose(1, 30) + shared), (None, prose(2, 30) + shared), (6, prose(3, 40)), (6, prose(4, 40) + shared), (None, shared[:300])]
    spec = Repeats()
    found = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup(documents(spark, rows), spec).collect())
    masks = removed([t.encode() for _, t in rows], spec.length)
    assert found == Counter((doc, len(t.encode()), int(m.sum())) for (doc, t), m in zip(rows, masks, strict=True))
    assert sum(n > 0 for _, _, n in found) == 4


@pytest.mark.parametrize("spec", [Repeats(20, 8), Repeats()])
def test_periodic_text(spark, spec):
    rows = [(1, "a" * 30_000), (2, "ab" * 5000 + prose(1, 60)), (3, "abc" * 90), (4, prose(2, 50)), (5, "abcdefghij" * 40 + prose(3, 40) + "abcdefghij" * 40)]
    found = by_id(suffix_dedup(documents(spark, rows), spec))
    for (doc, text), mask in zip(rows, removed([t.encode() for _, t in rows], spec.length), strict=True):
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        assert (found[doc].n_removed, found[doc].n_spans) == (int(mask.sum()), spans)


def test_periodic_text_is_one_stretch(spark):
    spec = Repeats()
    data = b"x" * 200_000
    keys, starts = sd.anchors(data, spec)
    row = (1, zstandard.compress(data), sorted(set(keys.view(np.int64).tolist())), [])
    texts = spark.createDataFrame([row], "doc_id long, packed binary, cold array<long>, hot array<long>")
    found = sd._segments(texts, spec).collect()
    assert len(starts) > 1000 and sum(len(r.lows) for r in found) < 10


def test_vectors_of_any_length_have_a_direction(spark):
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 0.0]), (4, [5e-324, 0.0]), (5, [1.0, 0.0]), (6, [-1e308, 1e308]), (7, [0.0, 1e-300])]
    found = by_id(range_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), "vec_id")
    assert {i: (r.n_links, r.component_id) for i, r in found.items()} == {
        1: (1, 1), 2: (1, 1), 3: (2, 3), 4: (2, 3), 5: (2, 3), 6: (0, 6), 7: (0, 7),
    }


@pytest.mark.parametrize("operator", [jaccard_components, suffix_dedup])
def test_edges(spark, operator):
    docs = documents(spark, edge_rows())
    found = operator(docs).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in edge_rows())
    assert operator(docs.limit(0)).collect() == []
    assert operator(docs.where(F.col("text").isNull())).count() == 2
