"""Line removal, collocations and fill-in-the-middle against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachbook.llm import collocations as C
from reachbook.llm import fill_middle as M
from reachbook.llm import line_dedup as L
from reachbook.llm import shards
from reachbook.llm.common import mix
from tests.llm.helpers import by_id, documents, edge_rows, prose

BLANKS = " \t\n\r\x0b\x0c"


def lower(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def same_rows(found, wanted) -> None:
    assert Counter(map(tuple, found)) == Counter(wanted)


# Shards.


def test_numbers_survive_packing():
    rng = np.random.default_rng(1)
    for kind in (np.uint32, np.uint64):
        for size in (0, 1, 1000):
            values = rng.integers(0, np.iinfo(kind).max, size, dtype=kind)
            assert (shards.unpack_numbers(shards.pack_numbers(values), kind) == values).all()
            values.sort()
            assert (shards.unpack_numbers(shards.pack_numbers(values, True), kind, True) == values).all()


def test_parts_hold_every_text_once(spark):
    rows = [(i, None if i % 7 == 0 else prose(i, i % 40)) for i in range(200)]
    docs = documents(spark, rows).select(F.col("doc_id").alias("id"), F.col("source").alias("label"), "text")
    parts = shards.gathered(docs, len, 3000).collect()
    assert len(parts) > 4
    found = []
    for r in parts:
        part = shards.Part(r.part, r.ids, r.labels, r.sizes, r.packed)
        texts = list(part.texts())
        assert r.units == sum(map(len, texts)) and sum(len(t) + 1 for t in texts[:-1]) < 3000
        found += zip(part.ids, (t.decode() for t in texts), strict=True)
    assert sorted(found) == sorted((i, t or "") for i, t in rows)


# Lines.


def plain_lines(rows: list[tuple], min_chars: int, min_docs: int) -> list[tuple]:
    keys = [[lower(line.strip(BLANKS)) for line in (text or "").split("\n")] for _, text, *_ in rows]
    docs = Counter(k for own in keys for k in set(own))
    out = []
    for (doc, text, *_), own in zip(rows, keys, strict=True):
        lines = (text or "").split("\n")
        kept = [line for line, k in zip(lines, own, strict=True) if len(k) < min_chars or docs[k] < min_docs]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    pool = ["", " ", "Terms apply.", "\tterms APPLY. ", "é", "É", "ab", "a b", "\x1cab", *[prose(i, 3) for i in range(40)]]
    rows = []
    for i in range(300):
        lines = [rng.choice(pool) if rng.random() < 0.6 else prose(1000 * i + j, 2) for j in range(rng.randint(0, 9))]
        rows.append((i, "\n".join(lines)))
    return rows + [(400 + i, "every document says this\nown " + prose(i, 2) + "\r\n") for i in range(150)]


@pytest.mark.parametrize("rule", [L.Rule(), L.Rule(min_chars=3, min_docs=2, part=800, shard=16), L.Rule(min_docs=300, part=3000, shard=64)])
def test_lines(spark, rule):
    rows = line_rows(3) + edge_rows() + [(500, "x\n" * 30_000)]
    wanted = plain_lines(rows, rule.min_chars, rule.min_docs)
    assert sum(r[2] for r in wanted) > 0 or rule.min_docs == 300
    same_rows(L.line_dedup(documents(spark, rows).repartition(5), rule=rule).collect(), wanted)


def test_lines_of_documents_that_are_there_twice(spark):
    rows = [(1, "same line\nother")] * 10 + [(None, "same line")]
    found = L.line_dedup(documents(spark, rows)).collect()
    same_rows(found, [(1, 2, 2, "")] * 10 + [(None, 1, 1, "")])


def test_no_lines(spark):
    assert L.line_dedup(documents(spark, [])).collect() == []
    same_rows(L.line_dedup(documents(spark, [(1, None), (2, "\n")])).collect(), [(1, 1, 0, ""), (2, 2, 0, "\n")])


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 5000])
def test_perfect_hash_numbers_every_line_once(n):
    rng = np.random.default_rng(n)
    places = rng.integers(0, 1 << 63, n).astype(np.uint64)
    prints = rng.integers(0, 1 << 32, n).astype(np.uint32)
    if n > 64:
        places[:50] = places[50]  # told apart by their prints alone
        prints[:60] = np.arange(60)
    perfect = L.PerfectHash.of(places, prints, 1.5)
    again = L.PerfectHash.load(perfect.dump())
    assert perfect.size == again.size == n
    assert sorted(again(places, prints).tolist()) == list(range(n))
    assert sum(len(x) for x in perfect.levels) * 64 <= 6 * n + 64 * 8


def test_lines_know_those_they_never_saw():
    rng = np.random.default_rng(2)
    places, prints = rng.integers(0, 1 << 63, 4000).astype(np.uint64), rng.integers(0, 1 << 32, 4000).astype(np.uint32)
    lines = L.Lines.of(places[:2000], prints[:2000], np.arange(1, 2001), L.Rule())
    assert (lines(places[:2000], prints[:2000]) == np.minimum(np.arange(1, 2001), 255)).all()
    assert not lines(places[2000:], prints[2000:]).any()


# Phrases.


def pieces_of(text: str | None) -> list[list[str]]:
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or ""))]


def plain_phrases(rows: list[tuple], rule: C.Rule) -> list[tuple]:
    f: dict[str, Counter] = {}
    n: Counter = Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] += len(words)
            for size in range(1, rule.most_words + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        phrases = {p: c for p, c in counts.items() if len(p) > 1 and c >= rule.least}
        ranked = []
        for p, a in phrases.items():
            cuts = [(rule.scale * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                100 * c >= rule.within_percent * a
                for q, c in phrases.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            )
            if not inside:
                ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[: rule.top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


def phrase_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = "new york city of the é É san . , francisco! mayor's\n at\x0b \tday ? 市 a".split(" ")
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))), rng.choice(["en", "de", None, "und", ""])) for i in range(150)]
    rows += [(200 + i, f"a hot phrase of five, {prose(i, 3)} " * 3, "en") for i in range(60)]
    return [(*r, "s1") for r in rows]


@pytest.mark.parametrize(
    "rule", [C.Rule(), C.Rule(least=4, top=40, part=600, mass=300), C.Rule(most_words=5, least=9, within_percent=30, part=2500, mass=2000)]
)
def test_phrases(spark, rule):
    rows = phrase_rows(5) + edge_rows()
    wanted = plain_phrases(rows, rule)
    assert len(wanted) >= (2 if rule.least == 30 else 10)
    same_rows(C.collocations(documents(spark, rows).repartition(4), rule=rule).collect(), wanted)


def test_no_phrases(spark):
    assert C.collocations(documents(spark, [])).collect() == []
    assert C.collocations(documents(spark, [(1, None), (2, ""), (3, "one . two")])).collect() == []


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    monkeypatch.setattr(C, "_STRETCH", 7)
    text = "a bb ccc. dddd eeeeeeeeeeee f\n g" * 3
    words = C.Words()
    found = np.concatenate(words(text.encode())).tolist()
    names = list(words.numbers)
    wanted = [w for p in pieces_of(text) for w in [*p, "|"]]
    told = ["|" if names[i] == b"\xff" else names[i].decode() for i in found]
    assert told == wanted


@pytest.mark.parametrize("seed", range(6))
def test_summaries_keep_what_is_frequent_in_bounded_room(seed):
    rng = np.random.default_rng(seed)
    least, truth = 30, Counter()
    streams = [rng.zipf(1.3, 3000) % 50_000 for _ in range(20)]
    mass = sum(map(len, streams))
    held = C.Summary(mass // least + 1)
    for i in range(0, 20, 4):
        some = []
        for s in streams[i : i + 4]:
            codes, counts = np.unique(s.astype(np.uint32), return_counts=True)
            truth.update(dict(zip(codes.tolist(), counts.tolist(), strict=True)))
            some.append((codes, counts))
        held.merge(some)
        assert len(held.codes) <= held.capacity
    assert len(truth) > held.capacity and 0 < held.taken < least
    kept = set(held.survivors(least).tolist())
    assert {c for c, n in truth.items() if n >= least} <= kept
    for code, counter in zip(held.codes.tolist(), held.counters.tolist(), strict=True):
        assert truth[code] - held.taken <= counter <= truth[code]


def test_shared_codes_keep_too_many_and_never_count_wrong(spark, monkeypatch):
    # Every n-gram has one of 16 codes.
    monkeypatch.setattr(C, "mix", lambda x: mix(x) & np.uint64(0xF))
    rule = C.Rule(least=5)
    rows = phrase_rows(6)
    part = shards.Part(1, [], ["en"] * len(rows), [], b"")
    part.texts = lambda: iter([r[1].encode() for r in rows])
    found = C.PartGrams(part, 1, rule.most_words)
    bits = np.ones(len(found.asked()), bool)
    assert len(bits) <= 16
    counted = Counter()
    for batch in C._phrases(found, [bits]):
        for row in batch.to_pylist():
            counted[row["phrase"]] += row["f"]
    words = [p for r in rows for p in pieces_of(r[1])]
    wanted = Counter(" ".join(p[i : i + n]) for p in words for n in range(1, 5) for i in range(len(p) - n + 1))
    assert {k: v for k, v in counted.items() if k is not None} == wanted and counted[None] == sum(map(len, words))


# Fill in the middle.

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fill(key, text, how: M.Infill = M.Infill()) -> tuple:
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"{how.seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in how.marks) or h[2] % 100 >= 100 - how.plain_percent:
        return key, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    p, s, m = how.marks
    spm = h[3] % 100 < how.spm_percent
    output = s + suffix + p + prefix + m + middle if spm else p + prefix + s + suffix + m + middle
    return key, n, "spm" if spm else "psm", len(prefix), len(middle), output


def random_text(rng: random.Random) -> str:
    size = rng.choice([0, 1, 4, 40, 400, 3000])
    return "".join(rng.choice("abé\n \t\x0b\x1c\U0001f600x<P>S市") for _ in range(size))


@pytest.mark.parametrize(
    "how", [M.Infill(), M.Infill(bits=3, least=2, most=20, memory=900), M.Infill(plain_percent=0, spm_percent=30, seed=7, prefix="[.*", middle="\\E")]
)
def test_fill(spark, how):
    rng = random.Random(4)
    rows = [(i, random_text(rng)) for i in range(400)] + edge_rows()
    found = M.fill_middle(documents(spark, rows), how=how).withColumn("back", M.restored(how=how)).collect()
    same_rows([tuple(r)[:-1] for r in found], [plain_fill(doc, text, how) for doc, text, *_ in rows])
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    same_rows([(r.doc_id, r.back) for r in found], [(doc, text or "") for doc, text, *_ in rows])
    assert M.fill_middle(documents(spark, [])).collect() == []


def test_cuts_need_no_tokens(monkeypatch):
    rng, how = random.Random(9), M.Infill(bits=4, least=3, most=40)
    memo = M.Memo(2000)
    shared = prose(1, 80)
    for _ in range(150):
        text = random_text(rng) + shared + random_text(rng)
        counted = M.Counted(text.encode(), how, memo)
        tokens = TOKEN.findall(text)
        assert counted.tokens == len(tokens)
        for n in {0, len(tokens), *rng.choices(range(len(tokens) + 1), k=4)}:
            prefix = "".join(tokens[:n])
            assert counted.cut(n) == (len(prefix.encode()), len(prefix))
    assert memo.hits > 10 * 150 / 2 and memo.held <= 2000


def test_chunks_follow_the_content():
    how = M.Infill()
    shared = prose(5, 6000).encode()
    ends = [M.chunk_ends(lead + shared, how) for lead in (b"", b"x" * 777)]
    cut = [{e - lead for e in own if e > lead} for own, lead in zip(ends, (0, 777), strict=True)]
    assert len(cut[0] & cut[1]) > 0.8 * len(cut[0]) > 10
    sizes = np.diff([0, *ends[0]])
    assert sizes[:-1].min() >= how.least and sizes.max() <= how.most
    assert M.chunk_ends(b"", how) == [] and M.chunk_ends(b"z" * 20_000, how) == [8192, 16384, 20_000]


def test_equal_hashes_do_not_share_a_summary(monkeypatch):
    monkeypatch.setattr(M.xxhash, "xxh3_64_intdigest", lambda chunk: 1)
    memo = M.Memo(1 << 20)
    assert memo(b"one two").runs == 2 and memo(b"three").runs == 1 and memo(b"one two").runs == 2
    assert memo.misses == 3


def test_queries_give_digests(spark):
    from reachbook.llm.queries import op13_fill_middle

    found = by_id(op13_fill_middle(spark, "/root/testdata/sf0.001"))
    texts = by_id(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    for doc, row in found.items():
        assert row.restored_sha256 == hashlib.sha256((texts[doc].text or "").encode()).hexdigest()
