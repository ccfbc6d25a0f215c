"""Periodic runs, whitening and toxicity against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from txspark.llm import periodic_runs, toxicity, whitening

pytest.importorskip("public_tokenizers")
from txspark.llm import queries  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "a", "é 漢字 \U0001f642", "word " * 30_000, "x" * 50_000, "42 17 --", "  ", "a b " * 12, "a b " * 12]


def brute_runs(words, least=24, times=3):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found[i, j + q] = min(q, found.get((i, j + q), q))
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic_texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        letters = rng.choice([1, 2, 3, 5, 50])
        words = [rng.randrange(letters) for _ in range(rng.randrange(160))]
        for _ in range(rng.randrange(4)):
            if words:
                a, p = rng.randrange(len(words)), rng.randrange(1, 12)
                words[a:a] = words[a : a + p] * rng.randrange(1, 7)
        yield [b"%d" % w for w in words * rng.choice([1, 1, 1, 2, 4])]


def test_runs_equal_brute_force():
    texts = list(periodic_texts(1, 400))
    for at in range(0, len(texts), 40):
        for words, got in zip(texts[at : at + 40], periodic_runs._described(texts[at : at + 40], periodic_runs.Limits()), strict=True):
            assert got[1] == brute_runs(words)


def test_runs_with_other_limits():
    limits = periodic_runs.Limits(least_words=30, least_periods=4)
    texts = list(periodic_texts(2, 60))
    for words, got in zip(texts, periodic_runs._described(texts, limits), strict=True):
        assert got[1] == brute_runs(words, 30, 4)
    with pytest.raises(ValueError):
        periodic_runs.Limits(least_words=23)


def test_candidates_in_pieces(monkeypatch):
    monkeypatch.setattr(periodic_runs, "CANDIDATES_AT_ONCE", 3)
    texts = list(periodic_texts(3, 30))
    for words, got in zip(texts, periodic_runs._described(texts, periodic_runs.Limits()), strict=True):
        assert got[1] == brute_runs(words)


@pytest.mark.parametrize("words", [[0] * 1000, [0, 1] * 300, list(range(200)) * 2, list(range(50)), [0, 1, 1] * 64 + [0, 1]])
def test_grammar_derives_its_text(words):
    g = periodic_runs.grammar(np.array(words))
    # every rule derives the same words wherever it stands, and twice at least
    for r in range(len(g.size)):
        places = g.at[g.rule == r]
        assert len(places) >= 2 and 0 < g.left[r] < g.size[r]
        assert len({tuple(words[p : p + g.size[r]]) for p in places.tolist()}) == 1
    assert g.top[0] == 0 and (np.diff(g.top) > 0).all()
    if len(set(words)) < len(words):
        assert len(g.top) < len(words)


def test_runs_of_odd_texts(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "n_runs long, text string").withColumn("runs", F.lit("mine"))
    rows = df.select("*", periodic_runs.detect(F.col("text")).alias("x")).collect()
    assert [r["runs"] for r in rows] == ["mine"] * len(ODD)
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        assert r["x"]["n_words"] == len(words)
        if len(words) < 1000:
            assert [tuple(x) for x in r["x"]["runs"]] == brute_runs(words)
    long = rows[5]["x"]
    assert tuple(long["strongest"]) == (0, 30_000, 1) and bytes(long["collapsed"]) == b"word"
    assert rows[9]["x"] == rows[10]["x"] and bytes(rows[9]["x"]["collapsed"]) == b"a b"
    assert rows[0]["x"]["strongest"] is None and bytes(rows[0]["x"]["collapsed"]) == b""
    assert df.limit(0).select(periodic_runs.detect(F.col("text"))).count() == 0


def test_runs_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op13_periodic_runs(spark, SMALL).collect()
    assert len(rows) == len(texts) and any(r["n_runs"] for r in rows)
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 2000:
            continue  # brute force is quadratic; these go through the SQL
        runs = brute_runs(words)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def exact(vectors):
    """Integer entries, mean, eigenvalues and eigenvectors of the covariance."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors])
    c = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(c.T @ c / len(x))
    return x, c, values[::-1], vectors[:, ::-1]


def check_whitening(rows, vectors, components):
    x, c, values, axes = exact(vectors)
    n = len(x)
    k = min(components, x.shape[1])
    total = [int(s) for s in x.sum(axis=0)]
    got = np.array([[p["whitened"] for p in r["whitening"]["components"]] for r in rows], float)
    assert got.shape == (n, k)
    for r, own in zip(rows, x, strict=True):
        w = r["whitening"]
        assert w["n"] == n and w["identity_error"] <= 1e-4
        assert w["deviation"] == sum((n * int(v) - s) ** 2 for v, s in zip(own, total, strict=True))
        assert [p["component"] for p in w["components"]] == list(range(1, k + 1))
        assert np.allclose([p["explained"] for p in w["components"]], values[:k] / values.sum(), rtol=1e-9)
    want = c @ axes[:, :k] / np.sqrt(values[:k])
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * sign).max() < 1e-8


VECTORS = "vec_id long, embedding array<float>, whitening string"


@pytest.mark.parametrize("shape", [(300, 5), (400, 40), (500, 100)])
def test_whitening_equals_eigenvectors(spark, shape):
    rng = np.random.default_rng(shape[1])
    x = rng.normal(size=shape) * np.linspace(3, 0.3, shape[1]) @ np.linalg.qr(rng.normal(size=(shape[1], shape[1])))[0]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), "mine") for i, v in enumerate(x)], VECTORS).repartition(3)
    settings = whitening.Settings(components=10, guard=8)
    out = whitening.whitened(df, "embedding", settings)
    assert out.columns == ["vec_id", "embedding", "whitening", "_whitening"]
    rows = out.withColumnRenamed("whitening", "w").withColumnRenamed("_whitening", "whitening").orderBy("vec_id").collect()
    check_whitening(rows, x, 10)


def test_whitening_goes_on_until_nothing_is_missed(spark):
    """A start that is blind to the first eigenvector is found out by the probes."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 60))
    x[:, 7] *= 30
    rows = spark.createDataFrame([([int(v) + 10**6 for v in 64 * r],) for r in x], "x array<bigint>").cache()
    model = whitening.fit(rows, "x", whitening.Settings(components=4, guard=2))[60]
    assert abs(model.vectors[7, 0]) > 0.99 and model.passes > 3
    q = np.linalg.qr(rng.normal(size=(60, 6)))[0]
    blind = q - model.vectors[:, :1] @ (model.vectors[:, :1].T @ q)
    probe = whitening._Probe(model.vectors[:, 0] + 0.1 * rng.normal(size=60), 1.0, 1.0, 5.0, 6)
    assert probe.log_odds(np.linalg.qr(blind)[0], 3.0) == 0.0


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [1.0, 2.0], [0.5, -3.25], [100.0, 0.015625], [-1e-3, 7.0]]
    odd = [None, [nan, 1.0], [1.0, inf], [None, 1.0], []]
    other = [[1.0, 1.0, 1.0]] * 3
    rows = [(i, v, "l") for i, v in enumerate(good + odd + other)] + [(None, [2.0, 2.0], None)]
    df = spark.createDataFrame(rows, VECTORS).drop("whitening")
    out = whitening.whitened(df, "embedding").collect()
    assert len(out) == len(good) + len(other) + 1
    own = sorted((r for r in out if len(r["embedding"]) == 2), key=lambda r: (r["vec_id"] is None, r["vec_id"]))
    check_whitening(own, [r["embedding"] for r in own], 32)
    flat = [r["whitening"] for r in out if len(r["embedding"]) == 3]
    assert all(w["n"] == 3 and w["deviation"] == 0 and w["identity_error"] == 0 for w in flat)
    assert all(p["whitened"] is None and p["explained"] is None for w in flat for p in w["components"])
    for nothing in (df.limit(0), df.where("vec_id in (5, 6, 9)")):
        empty = whitening.whitened(nothing, "embedding")
        assert empty.count() == 0 and empty.columns == ["vec_id", "embedding", "whitening"]


def test_more_components_than_vectors(spark):
    x = np.random.default_rng(1).normal(size=(6, 50))
    df = spark.createDataFrame([(i, v.tolist(), "l") for i, v in enumerate(x)], VECTORS).drop("whitening")
    rows = whitening.whitened(df, "embedding", whitening.Settings(components=8, guard=4)).collect()
    for r in rows:
        shown = [p["whitened"] is not None for p in r["whitening"]["components"]]
        assert shown == [True] * 5 + [False] * 3 and r["whitening"]["identity_error"] < 1e-9


def test_large_deviations_stay_exact():
    centre = whitening._Centre(10**7, [10**13 + 3, 10**13 - 1])
    x = np.array([[1_000_050, 999_990], [1_000_000, 1_000_000]])
    want = [sum((10**7 * int(v) - s) ** 2 for v, s in zip(r, (10**13 + 3, 10**13 - 1), strict=True)) for r in x]
    assert centre.deviations(x) == want
    with pytest.raises(OverflowError):
        whitening._Centre(10**9, [10**15, 10**15]).deviations(x)


def test_whitening_query(spark):
    rows = queries.op12_embedding_whitening(spark, SMALL)
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    found = rows.collect()
    assert len(found) == 32 * len(vectors)
    ids = sorted(vectors)
    x, c, values, axes = exact([vectors[i] for i in ids])
    got = {(r["vec_id"], r["component"]): r["whitened"] for r in found}
    got = np.array([[got[i, k] for k in range(1, 33)] for i in ids])
    want = c @ axes[:, :32] / np.sqrt(values[:32])
    assert np.abs(got - want * np.sign((got * want).sum(axis=0))).max() < 1e-6


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_the_nearest(seed):
    rng = np.random.default_rng(seed)
    terms = 60

    def vector():
        ids = np.unique(np.minimum(rng.zipf(1.4, rng.integers(1, 12)) - 1, terms - 1))
        w = rng.choice([0.5, 1.0, 2.0], len(ids))
        return ids, w / np.linalg.norm(w)

    vectors = [vector() for _ in range(700)]
    index = toxicity.BlockMaxIndex(vectors, terms, 16)
    dense = np.zeros((700, terms))
    for i, (ids, w) in enumerate(vectors):
        dense[i, ids] = w
    visited = []
    scored = index._scored
    index._scored = lambda blocks, *rest: visited.append(len(blocks)) or scored(blocks, *rest)
    for _ in range(60):
        ids, w = vector()
        near, cosines = index.nearest(ids, w, 9)
        all_of = dense[:, ids] @ w
        best = np.sort(all_of[all_of > 0])[::-1][:9]
        assert np.allclose(cosines, best) and np.allclose(all_of[near], cosines)
        assert len(set(near.tolist())) == len(best)
    assert sum(visited) < 60 * index.blocks  # blocks are skipped
    assert len(toxicity.BlockMaxIndex([], 3, 16).nearest(np.array([0]), np.array([1.0]), 5)[0]) == 0


def held_out(column):
    return F.coalesce(F.crc32(column.cast("string")) % 3 == 1, F.lit(False))


def test_toxicity_on_held_out_rows(spark):
    where = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{where}/labels.parquet")
    rows = queries.op11_toxicity(spark, where)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == spark.read.parquet(f"{where}/documents.parquet").count()
    seen = rows.where("held_out").join(labels, "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in seen) / len(seen)
    toxic = [r for r in seen if r["toxic"] == 1]
    assert right > 0.98 and sum(r["predicted"] for r in toxic) > 0.8 * len(toxic)
    assert sum(r["predicted"] for r in seen if r["toxic"] == 0) <= 0.002 * len(seen)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in seen)
    # scores are probabilities: they agree with the share of toxic texts
    assert abs(np.mean([r["score"] for r in seen]) - len(toxic) / len(seen)) < 0.02


def taught(spark, n=240):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(30, 90))]
        if i % 6 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["Wretch", "WRETCHED", "wretchling"]))
        rows.append((i, " ".join(words), i % 6 == 0))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    return docs, labels


def test_toxicity_learns_stems_and_shows_evidence(spark):
    docs, labels = taught(spark)
    model = toxicity.train(docs, labels, "text", "doc_id", "toxic")
    texts = [(1, "some wretchful and other wretchdom among these words here " * 3), (2, "plain words about nothing at all " * 5), *enumerate(ODD, 10)]
    df = spark.createDataFrame(texts, "score long, text string").withColumn("neighbours", F.lit("mine"))
    rows = {r["score"]: r for r in df.select("*", toxicity.score(model, F.col("text")).alias("x")).collect()}
    assert rows[1]["x"]["score"] > 0.7 and "wretch*" in rows[1]["x"]["terms"]
    assert rows[1]["x"]["neighbours"][0]["share"] == 1 and int(rows[1]["x"]["neighbours"][0]["example"]) % 6 == 0
    assert rows[2]["x"]["score"] < 0.2 and rows[2]["x"]["terms"] == []
    for r in rows.values():
        assert r["neighbours"] == "mine" and 0 <= r["x"]["score"] <= 1
        cosines = [n["cosine"] for n in r["x"]["neighbours"]]
        assert cosines == sorted(cosines, reverse=True)
    assert rows[10]["x"]["score"] == rows[11]["x"]["score"] == pytest.approx(1 / 6)
    assert rows[19]["x"] == rows[20]["x"]
    assert df.limit(0).select(toxicity.score(model, F.col("text"))).count() == 0


def test_whole_texts_count(spark):
    docs, labels = taught(spark)
    model = toxicity.train(docs, labels, "text", "doc_id", "toxic")
    clean = "plain words about nothing at all " * 20
    assert model.score(clean + " wretch wretched wretchling" * 4)[0] > 0.5 > model.score(clean)[0]


def test_toxicity_without_labels_or_with_one(spark):
    docs, labels = taught(spark, 12)
    none = toxicity.train(docs, labels.limit(0), "text", "doc_id", "toxic")
    assert none.score("wretch")[0] == 0.5
    assert toxicity.train(docs, labels.selectExpr("doc_id", "cast(null as int) toxic"), "text", "doc_id", "toxic").score("a")[0] == 0.5
    clean = toxicity.train(docs, labels.where("toxic = 0"), "text", "doc_id", "toxic")
    assert clean.score("wretch")[0] < 1e-6 and clean.score(None)[0] == 0.0
    empty = toxicity.train(docs.limit(0), labels, "text", "doc_id", "toxic")
    assert empty.score("wretch")[0] == 0.5
    doubled = toxicity.train(docs.union(docs), labels.union(labels), "text", "doc_id", "toxic")
    once = toxicity.train(docs, labels, "text", "doc_id", "toxic")
    assert doubled.named == once.named and doubled.score("a b")[0] == pytest.approx(once.score("a b")[0], abs=0.05)
