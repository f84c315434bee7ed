"""op9: every counted expression takes part, by whichever way its value reaches a text."""

import functools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import toxicity
from tickframe.llm.toxicity import ORDER


def by_dictionaries(rows, texts, d=0.75):
    """gram -> weighed log ratio of {gram: (n0, n1, q0, q1)} in one model, where ``rows`` has grams of all models."""
    tail = lambda g, k: g & ((1 << (8 * k)) - 1)
    suffixes = {k: {tail(g, k) for g in rows} for k in range(1, ORDER + 1)}
    left, follow = {}, {}
    for k in range(1, ORDER):
        for u in suffixes[k + 1]:
            left[k, tail(u, k)] = left.get((k, tail(u, k)), 0) + 1
        for u in suffixes[k]:
            follow.setdefault((k, u >> 8), []).append(u)

    @functools.cache
    def shared(u, k):
        if not k:
            return 1 / 256
        f = follow[k, u >> 8]
        total = sum(left[k, x] for x in f)
        return max(left[k, u] - d, 0) / total + d * len(f) / total * shared(tail(u, k - 1), k - 1)

    by_context, out = {}, {}
    for g, n in rows.items():
        by_context.setdefault(g >> 8, []).append(n)
    for g, n in rows.items():
        q = n[2:]
        h = 2 * sum(x * math.log(x / (sum(q) * t / sum(texts))) for x, t in zip(q, texts, strict=True) if x)
        if h <= 6:
            continue
        p = []
        for c in (0, 1):
            all_n = [x[c] for x in by_context[g >> 8]]
            back = d * sum(x > 0 for x in all_n) / sum(all_n) if sum(all_n) else 1.0
            p.append(max(n[c] - d, 0) / max(sum(all_n), 1) + back * shared(tail(g, ORDER - 1), ORDER - 1))
        r = math.log(p[1] / p[0])
        if abs(r) > math.log(2) and (r > 0) == (q[1] * texts[0] > q[0] * texts[1]):
            out[g] = r * (1 - 6 / h)
    return out


def six_grams(text):
    """Each byte and the five before it, back to the space in front of the word that holds or ends before it."""
    plain, out, before = b" " * ORDER, [], ORDER - 1
    for c in text.encode():
        x = chr(c)
        plain += b"0" if x in "0123456789" else x.lower().encode() if c < 128 and x.isalpha() else b" " if c < 128 else bytes([c])
    for i in range(ORDER, len(plain)):
        out.append(int.from_bytes(plain[max(before, i - ORDER + 1) : i + 1].rjust(ORDER), "big"))
        if plain[i] == 32:
            before = i
    return out


def test_the_whole_score_by_brute_force(spark):
    """Every row of a whole table: models of all training rows and of all but one fold, evidence, and the fitted curve."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    marks = {r.doc_id: r.toxic for r in labels.where("toxic is not null").collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 4 for i in texts}
    train = [i for i in marks if i in texts and fold[i] != 2]
    grams = {i: six_grams(t) for i, t in texts.items()}
    every = {g: [0, 0, 0, 0] for i in train for g in grams[i]}

    def model(rows):
        n = {g: list(x) for g, x in every.items()}
        for i in rows:
            for g, k in Counter(grams[i]).items():
                n[g][marks[i]] += k
                n[g][2 + marks[i]] += 1
        return by_dictionaries(n, [sum(marks[i] == c for i in rows) for c in (0, 1)])

    evidence = lambda i, m: sum(m.get(g, 0) for g in grams[i]) / max(len(texts[i].encode()), 1)
    whole, without = model(train), {f: model([i for i in train if fold[i] != f]) for f in (0, 1, 3)}
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert len(whole) > 20 and len(got) == len(texts)
    assert [got[i].evidence for i in texts] == pytest.approx([evidence(i, whole) for i in texts], abs=1e-6)
    x = np.array([evidence(i, without[fold[i]]) for i in train])
    y, w, spread = np.array([marks[i] for i in train]), np.zeros(2), x.std()
    a = np.stack([np.ones(len(x)), x / spread], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-a @ w))
        w += np.linalg.solve((a.T * (p * (1 - p))) @ a + np.diag([0, 0.05]), a.T @ (y - p) - np.array([0, 0.05]) * w)
    want = [1 / (1 + math.exp(-(w[0] + w[1] * evidence(i, whole) / spread))) for i in texts]
    assert [got[i].score for i in texts] == pytest.approx(want, abs=0.01)


def test_a_small_table_finds_toxic_rows(spark):
    """The level at which a fixed bound on counts found nothing; labelled rows that are counted, so no held-out row is looked at."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    got = toxicity.score(docs, labels).where("not held_out").join(labels, "doc_id").groupBy("toxic").agg(F.sum("predicted").alias("n"), F.count(F.lit(1)).alias("all"))
    n = {r.toxic: (r.n, r["all"]) for r in got.collect()}
    assert n[1][0] >= 0.6 * n[1][1] and n[0][0] <= 0.02 * n[0][1]


def test_an_expression_of_few_texts_counts_in_a_large_table(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(400)]
    counted = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 4 < 2]
    toxic = set(counted[:12])
    rows = [(i, " ".join(words) + (" vilest" if i in counted[:8] else "")) for i in counted] + [(-1, "vilest")]
    marks = spark.createDataFrame([(i, int(i in toxic)) for i in counted], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, marks)
    assert len(model.keys) > 0
    assert toxicity.evidence(docs.where("doc_id = -1"), model, ["doc_id"]).first().evidence > 0


@pytest.mark.parametrize("front", [0, 1])
def test_values_outside_the_front_count_alike(spark, front):
    rng, words = random.Random(3), "one two three four five six seven eight nine ten eleven twelve thirteen".split()
    rows = [(i, " ".join([rng.choice(words) for _ in range(40)] + ["vilest", rng.choice(["nasty", "grim", "foul"])] * (i % 4 == 0))) for i in range(300)]
    rows += [(None, None), (-1, ""), (-1, ""), (-2, "nasty words"), (-2, "nasty words"), (-3, "foul " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, front)
    assert model.rest.count() > 0 and len(model.keys) == front
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.evidence)
    one, two = (sorted(toxicity.score(docs, labels, front=f).collect(), key=key) for f in (front, 1 << 20))
    assert len(one) == len(two) == docs.count()
    assert any(r.evidence > 0 for r in one)
    assert [r.evidence for r in one] == pytest.approx([r.evidence for r in two], abs=1e-9)
    assert [r.score for r in one] == pytest.approx([r.score for r in two], abs=1e-6)


def test_a_kept_text_travels_once(spark, monkeypatch):
    """Evidence is the same whether the text is kept or not, null and empty ones too, and what is kept goes to Python with no second copy."""
    texts = [None, "", *(f"plain words {i % 7}" for i in range(60)), *(f"vile{i % 3} rot words" for i in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.where("doc_id > 1").select("doc_id", F.col("text").startswith("vile").cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    sent, given = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **k: sent.append([c for c, t in self.dtypes if t == "string"]) or given(self, *a, **k))
    kept = {r.doc_id: (r.text, r.evidence) for r in toxicity.evidence(docs, model, ["doc_id", "text"]).collect()}
    alone = {r.doc_id: r.evidence for r in toxicity.evidence(docs, model, ["doc_id"]).collect()}
    assert sent == [["text"], ["_whole"]]
    assert kept == {i: (t, alone[i]) for i, t in enumerate(texts)} and alone[0] == alone[1] == 0 < alone[121]


@pytest.mark.parametrize("front", [1 << 20, 0])
def test_a_task_holds_one_python_worker(spark, monkeypatch, front):
    """No stage passes rows from one Python worker to another, and rows without a label stay out of the curve all the same."""
    docs = spark.createDataFrame([(i, f"vile{i % 3} rot words" if i % 2 else f"plain words {i % 7}") for i in range(400)], "doc_id long, text string")
    labels = docs.where("doc_id < 200").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    plans, curves, put, fit_curve = [], [], toxicity.stored, toxicity.curve
    monkeypatch.setattr(toxicity, "stored", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or put(df, name))
    monkeypatch.setattr(toxicity, "curve", lambda seen: curves.append(seen.count()) or fit_curve(seen))
    out = toxicity.scored(docs, labels, ["doc_id", "text"], front=front)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum("MapInArrow" in p for p in plans) >= 3
    assert max(stage.count("MapInArrow") for p in plans for stage in p.split("Exchange")) == 1
    trained = docs.where("doc_id < 200").where(toxicity.fold_of() != 2).count()
    assert curves == [trained]
    assert out.count() == 400 and out.where((F.col("score") >= 0.3) != (F.col("doc_id") % 2 == 1)).count() == 0
