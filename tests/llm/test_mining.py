"""Phrases, shards and spelling variants: contracts against brute force, hot keys, and the edges that their modules state."""

import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import phrases, queries, sharding, spelling
from tickframe.llm.common import Bytes

from . import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n long, w string, w1 long, bucket int, row string, word string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "x", 1, 1, "r", "w") for i, t, lang in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]


EDGES = [
    (1, None, "en"),
    (2, "", "en"),
    (3, "a b c d e, a b c d. a b\nc d", None),
    (3, "a b c d e, a b c d. a b\nc d", None),
    (None, "A B C D", "und"),
    (4, "\t.,;:!? \x0b\x0c", "en"),
    (5, "one", "en"),
    (6, "na " * 30_000, "en"),
    (7, "é É ü. é É ü é É ü", "fr"),
    (8, "x y, y x y x; x", "en"),
    (None, None, None),
]


@pytest.mark.parametrize("least,top,share,slack", [(2, 5, 0.25, 0.67), (2, 2000, 0.0, 1.0)])
def test_phrases_of_edges(spark, least, top, share, slack):
    """A sample of nothing proposes nothing, and one that asks for too much proposes little: the border's failures are then all there is."""
    got = phrases.collocations(frame(spark, EDGES), least, top, share, slack)
    assert sorted(map(tuple, got.collect())) == brute.collocations([(lang, t) for _, t, lang in EDGES], least, top)
    assert phrases.collocations(frame(spark, []), least, top, share, slack).count() == 0


@pytest.mark.parametrize("least,share,slack", [(3, 0.25, 0.67), (6, 0.1, 3.0)])
def test_phrases_of_documents(spark, docs, least, share, slack):
    got = phrases.collocations(frame(spark, docs), least, 300, share, slack)
    assert sorted(map(tuple, got.collect())) == brute.collocations([(lang, t) for _, t, lang in docs], least, 300)


def test_border_fails_and_is_closed(spark):
    """Nothing of two words is proposed, so longer phrases come out of the last pass alone: all that have a failed one inside."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(60)), "en") for i in range(60)]
    frame_ = frame(spark, rows)
    words, salt = phrases.vocabulary(frame_)
    one = phrases.sieve(words.select("h"))
    full = phrases.summed(frame_, salt, one, 3, (2, 3, 4))
    assert full.where("h & 3 > 1").count() == 0
    bad = phrases.sieve(full.where("n >= 60").select("h"))
    more = {tuple(x for x in r[:4] if x is not None): r.n for r in phrases.counted(frame_, salt, one, bad, bad).collect()}
    ids = {r.word: r.id for r in words.collect()}
    all_of = Counter(tuple(ids[x] for x in t.split()[i : i + k]) for _, t, _ in rows for k in (2, 3, 4) for i in range(61 - k))
    hot = {w for w, n in all_of.items() if len(w) == 2 and n >= 60}
    want = {w: n for w, n in all_of.items() if any(w[i : i + 2] in hot for i in range(len(w) - 1))}
    assert hot and len(want) < len(all_of) and {w: n for w, n in more.items() if w in want} == want


def test_sieve_holds_what_it_was_built_from(spark):
    h = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 3000)
    rows, put = spark.createDataFrame([(int(x),) for x in h], "h long"), h.view(np.uint64)
    s = phrases.sieve(rows, block_bits=10).value
    assert s.holds(put).all() and s.holds(put + np.uint64(1 << 40)).mean() < 0.1
    small = phrases.sieve(rows, most_bits=8, block_bits=6).value  # full: lets all through, loses none
    assert len(small.cells) == 32 and small.holds(put).all()


def test_a_full_sieve_changes_nothing(spark, docs):
    got = phrases.collocations(frame(spark, docs), 4, 200, sieve_bits=13)
    assert sorted(map(tuple, got.collect())) == brute.collocations([(lang, t) for _, t, lang in docs], 4, 200)


def test_ids_of_words():
    text = "one two one Two ätwo twoä one".encode()
    b = Bytes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    ids = [phrases.words_of(b, ["en"], salt)[4] for salt in (1, 2)]
    for x in ids:
        assert x[0] == x[2] == x[6] and x[1] == x[3] and len(set(x.tolist())) == 4
    assert not set(ids[0].tolist()) & set(ids[1].tolist()) and not set(ids[0].tolist()) & set(phrases.words_of(b, ["de"], 1)[4].tolist())


def test_score_of_huge_counts(spark):
    a, b = 9_000_000_000_000_000_000, 9_223_372_036_854_775_000
    r = spark.range(1).select(phrases.whole_part(F.lit(a), F.lit(b), 2_000_000).alias("x"), phrases.whole_part(F.lit(1), F.lit(3), 2_000_000).alias("y")).first()
    assert r.x == 2_000_000 * a // b and r.y == 666_666


def records(got):
    return [(r.shard, r.slot, r["size"], r.text_crc32, r.row.doc_id, r.row.text) for r in got.collect()]


@pytest.mark.parametrize("n,bucket_bytes", [(7, 1000), (40, 16 << 20), (1, 300)])
def test_shards_are_even_and_whole(spark, docs, n, bucket_bytes):
    rows = docs + EDGES
    got = records(sharding.shards(frame(spark, rows), n, bucket_bytes=bucket_bytes))
    want = Counter((len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), i, t) for i, t, _ in rows)
    assert Counter(x[2:] for x in got) == want
    sizes = Counter(x[0] for x in got)
    assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(n)) <= 1 and set(sizes) <= set(range(n))
    for k in sizes:
        assert sorted(x[1] for x in got if x[0] == k) == list(range(sizes[k]))


def test_shards_are_seeded_and_random(spark):
    rows = frame(spark, [(i, f"text {i}", "en") for i in range(4000)])
    order = lambda seed: [x[4] for x in sorted(records(sharding.shards(rows, 4, seed, 20_000)))]
    one, again, other = order(1), order(1), order(2)
    assert one == again and one != other and sorted(one) == list(range(4000))
    place = np.argsort(one)  # of each id
    assert abs(np.corrcoef(np.arange(4000), place)[0, 1]) < 0.08
    assert max(Counter(place[:1000] // 1000).values()) < 330  # the first thousand ids lie in all shards alike
    gaps = np.abs(np.diff(place))
    assert 1100 < gaps.mean() < 1600  # a third of 4000


def test_a_hot_id_is_dealt_to_many_buckets(spark):
    rows = frame(spark, [(None if i % 3 == 0 else i, "same text " * 10, "en") for i in range(3000)])
    held = sharding.shuffled(rows, bucket_bytes=20_000)
    sizes = [r.n for r in held.groupBy("bucket").agg(F.sum("size").alias("n")).collect()]
    assert sum(sizes) == 3000 * 116 and max(sizes) < 45_000 and len(sizes) > 10


def test_shards_of_nothing_and_written_folders(spark, docs):
    assert sharding.shards(frame(spark, []), 3).count() == 0
    with pytest.raises(ValueError):
        sharding.shards(frame(spark, docs), 0)
    path = sharding.write_shards(sharding.shards(frame(spark, docs), 5))
    back = spark.read.parquet(path)
    assert sorted(x for x in os.listdir(path) if x.startswith("shard=")) == [f"shard={k}" for k in range(5)]
    assert Counter(r.row.doc_id for r in back.collect()) == Counter(i for i, _, _ in docs)


def test_spelling_of_documents(spark, docs):
    words = {r.word: r.n for r in spelling.vocabulary(frame(spark, docs), every=7, least_n=2).collect()}
    assert words == brute.vocabulary([(i, t) for i, t, _ in docs], every=7, least_n=2)
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert sorted(map(tuple, got.collect())) == brute.variants(words)


def test_spelling_query(spark, docs):
    got = queries.op13_spelling(spark, SF)
    assert sorted(map(tuple, got.collect())) == brute.variants(brute.vocabulary([(i, t) for i, t, _ in docs]))


@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_near_words_of_few_letters(spark, limit):
    """Words that share their vectors, so that leaves are large and branches are searched in blocks."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))): rng.randrange(3, 60) for _ in range(150)}
    words |= {"z" * 3000: 9, "z" * 3001: 30, "z" * 2999 + "y": 70, "ab": 5, "ba": 5, "ÿÿÿÿÿ": 3, "ÿÿÿÿ×": 6}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [tuple(r) for r in spelling.near_pairs(table, limit).collect()]
    assert len({frozenset(p) for p in pairs}) == len(pairs)
    assert sorted(map(tuple, spelling.variants(table, limit).collect())) == brute.variants(words)


def test_roots_of_long_chains(spark):
    forms = [(f"w{i:03}", f"w{i + 1:03}") for i in range(60)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {w: "w060" for w, _ in forms}


def test_spelling_edges(spark):
    rows = [(i, t, "en") for i, t in [(None, "Straße ÀÉ× naïve naïves"), (1, None), (2, ""), (3, "abc 1234 ___"), (4, "naïve " * 20_000), (5, "naïve"), (5, "naïve"), (5, "naïves naives naives naives")]] * 3
    for every in (97, 2):
        got = spelling.variants(spelling.vocabulary(frame(spark, rows), every=every))
        assert sorted(map(tuple, got.collect())) == brute.variants(brute.vocabulary([(i, t) for i, t, _ in rows], every=every))
    assert spelling.spelling_variants(frame(spark, [])).count() == 0
