"""Language, tokens, quality rules, quality scores, personal data and secrets."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txspark.llm import bpe, factorisation, language_id, pii, quality_rules, secret_scan

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n ", "a", "é 漢字 \U0001f642", "word " * 30_000, "x" * 50_000, "42 17 --"]


def docs_of(spark, texts, **more):
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    for name, value in more.items():
        df = df.withColumn(name, F.lit(value))
    return df


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def test_language_on_held_out_rows(documents):
    cut = F.col("doc_id") % 4 == 0
    net = language_id.train(documents.where(~cut), "text", "lang", "doc_id")
    seen = documents.where(cut & (F.length("text") > 80)).select("lang", language_id.predict(net, F.col("text")).alias("p")).collect()
    assert np.mean([r["lang"] == r["p"]["lang"] for r in seen]) > 0.97
    assert all(0 <= r["p"]["score"] <= 1 for r in seen)


def test_language_of_odd_texts(spark, documents):
    net = language_id.train(documents.limit(200), "text", "lang", "doc_id", language_id.Shape(epochs=1))
    rows = docs_of(spark, ODD, lang_pred="kept").select("text", "lang_pred", language_id.predict(net, F.col("text")).alias("p")).collect()
    for r in rows:
        wordless = r["text"] is None or not any(map(str.isalpha, r["text"]))
        assert (r["p"]["lang"] == "und") == wordless
        assert r["lang_pred"] == "kept"
    empty = docs_of(spark, []).select(language_id.predict(net, F.col("text")).alias("p"))
    assert empty.count() == 0
    assert language_id.train(docs_of(spark, [None, ""]), "text", "lang", "doc_id") is None
    assert docs_of(spark, ["a"]).select(language_id.predict(None, F.col("text")).alias("p")).first()["p"]["lang"] == "und"


def test_every_window_counts(documents):
    net = language_id.train(documents, "text", "lang", "doc_id")
    en, de = (max((r["text"] for r in documents.where(F.col("lang") == x).limit(50).collect()), key=len)[:2000] for x in ("en", "de"))
    assert language_id.predict_texts(net, [en + (de + "\n") * 12])[0] == ["de"]


def test_bpe_equals_the_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    letters = "ab the'stde1  \n\t\x1c\x85\xa0.,!?é漢字\U0001f642<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [*ODD, "ab" * 4000, "a" * 3000]
    df = docs_of(spark, texts).withColumn("ids", bpe.encode(F.col("text"), path, public_tokenizers.PATTERN))
    df = df.withColumn("back", bpe.decode(F.col("ids"), path, public_tokenizers.PATTERN))
    for r in df.collect():
        text = r["text"] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == known.encode_ordinary(text)
        assert bytes(r["back"]) == text.encode()


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def test_quality_base_counts(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcde#") for _ in range(rng.randrange(80))).replace("a b", "\n") for _ in range(60)]
    texts += [*ODD[:6], "one two three four five " * 3, "l1\nl1\nl1 \n\n\nl1", "a\x0bb\x1cc\rd"]
    docs = docs_of(spark, texts).select("doc_id", "text", "lang")
    counted = quality_rules.histograms(quality_rules.base_counts(docs, "text")).cache()
    refs = quality_rules.references(counted, "lang")
    judged = quality_rules.judge(counted, refs, quality_rules.Limits())
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for r in judged.select("text", "kept", *columns).collect():
        assert tuple(r[c] for c in columns) == brute_base(r["text"])
        assert not (r["kept"] and r["base_failed"])


def test_quality_filter_keeps_rows_as_they_are(spark, documents):
    odd = docs_of(spark, ODD).withColumn("kept", F.lit("mine")).withColumn("_words", F.lit(7))
    assert quality_rules.keep_documents(odd, "text", "lang").columns == odd.columns
    kept = quality_rules.keep_documents(documents, "text", "lang")
    assert kept.schema == documents.schema
    labels = kept.sparkSession.read.parquet(f"{SF}/labels.parquet")
    long = documents.where(F.size(F.split("text", " ")) > 20).join(labels, "doc_id")
    shares = {r["quality"]: r["s"] for r in long.join(kept.select("doc_id", F.lit(1).alias("k")), "doc_id", "left").groupBy("quality").agg(F.avg(F.coalesce("k", F.lit(0))).alias("s")).collect()}
    assert shares[1] > 0.95 and shares[0] < 0.15
    assert quality_rules.keep_documents(docs_of(spark, []), "text", "lang").count() == 0


def test_quality_scores(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = F.col("doc_id") % 4 == 1
    machine = factorisation.train(documents, labels.where(~out), "text", "n_chars", "doc_id", "quality")
    scored = documents.join(labels.where(out), "doc_id").select("quality", factorisation.score(machine, F.col("text"), F.col("n_chars")).alias("s")).collect()
    good, bad = ([r["s"] for r in scored if r["quality"] == q] for q in (1, 0))
    wins = np.mean([g > b for g in good for b in bad])
    assert wins > 0.9
    odd = docs_of(spark, ODD, score=1).select(factorisation.score(machine, F.col("text"), F.col("n_chars")).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in odd)
    blank = factorisation.train(docs_of(spark, []), labels.where("false"), "text", "n_chars", "doc_id", "quality")
    assert docs_of(spark, ["a"]).select(factorisation.score(blank, F.col("text"), F.col("n_chars")).alias("s")).first()["s"] == 0.5


def test_quality_scores_are_calibrated(spark):
    """The query's verdicts at its cut, on rows that no training saw, and its columns."""
    from txspark.llm import queries

    where = "/root/testdata/sf0.1"
    rows = queries.op9_factorisation_machine(spark, where)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    seen = rows.join(spark.read.parquet(f"{where}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in seen]) > 0.985
    assert abs(np.mean([r["score"] for r in seen]) - np.mean([r["quality"] for r in seen])) < 0.02
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in seen)


def test_calibration_of_few_rows():
    shape = factorisation.Shape(buckets=4, factors=2)
    size = 4 + factorisation.STATISTICS
    made = lambda: factorisation.Machine(shape, 0.0, np.eye(1, size)[0], np.zeros((size, 2)))
    rows = [(np.array([0]), np.array([z])) for z in (-3.0, -1.0, 5.0, 9.0)]
    machine = made()
    factorisation.calibrate(machine, rows, np.array([0.0, 0.0, 0.0, 1.0]))
    assert machine.score(*rows[3]) > 0.5 > machine.score(*rows[2])
    for labels in ([1.0] * 4, [0.0] * 4, [1.0, 1.0, 0.0, 0.0]):  # one label, or order reversed
        machine = made()
        factorisation.calibrate(machine, rows, np.array(labels))
        assert (machine.slope, machine.offset) == (1.0, 0.0)


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    machine = factorisation.Machine(factorisation.Shape(buckets=5), 0.1, rng.normal(size=12), rng.normal(size=(12, 3)))
    index, value = np.array([1, 4, 7]), np.array([0.5, -2.0, 1.5])
    pairs = sum(value[i] * value[j] * machine.factors[index[i]] @ machine.factors[index[j]] for i in range(3) for j in range(i))
    z = 0.1 + value @ machine.linear[index] + pairs
    assert machine.score(index, value) == pytest.approx(1 / (1 + np.exp(-z)))


def brute_pii(text):
    text = text or ""
    spans = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 14 <= len(d) <= 19 and total % 10 == 0:
            spans.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((m.start(), 3, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


PERSONAL = [
    "write a.b@x.org, a@b.c@d.e.f x@y x@@y.z me@-.-.",
    "at 1.2.3.4.5.6.7.8 and 256.1.1.1 or 001.02.3.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5 4111111111111111 4111  1111 1111 1111",
    "+1 (555) 123-4567 +12345 +44 20 7946 0958. +1+2 ++49 30 1234567",
    "é\U0001f642 q@w.ee 79927398713 0000 0000 0000 00",
    "9" * 5000 + " 1.2.3.4 " + "a" * 20_000 + "@b.cc " + "1." * 3000,
]


def test_base_spans_equal_brute_force(spark, documents):
    rng = random.Random(9)
    texts = ["".join(rng.choice("1234.+- @a(") for _ in range(rng.randrange(90))) for _ in range(300)] + PERSONAL + ODD
    docs = docs_of(spark, texts)
    model = pii.train(documents, "text")
    for r in pii.detect(docs.select("doc_id", "text"), "text", model).collect():
        expected = brute_pii(r["text"])
        assert r["base_spans"] == expected
        assert set(filter(None, expected.split(","))) <= set(r["spans"].split(","))
        assert r["n_email"] == expected.count("email")
    found = pii.detect(documents.select("doc_id", "text"), "text", model).collect()
    assert all(r["base_spans"] == brute_pii(r["text"]) for r in found)


def test_redaction(spark, documents):
    docs = docs_of(spark, [*PERSONAL, *ODD]).withColumn("doc", F.lit(1)).withColumn("spans", F.lit("s"))
    out = pii.redact_documents(docs, "text", pii.Model())
    assert out.columns == docs.columns
    for r in out.collect():
        assert brute_pii(r["text"]) == ""
        assert r["spans"] == "s"
    assert out.where("doc_id = 0").first()["text"].startswith("write [EMAIL], [EMAIL]")
    assert out.where("text IS NULL").count() == 1
    clean = documents.where(~F.col("text").rlike("[0-9@]"))
    assert clean.exceptAll(pii.redact_documents(clean, "text", pii.train(documents, "text"))).isEmpty()


def test_secrets(spark, documents):
    rng = random.Random(4)
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)) for _ in range(60)]
    more = docs_of(spark, [f"thand of the {k} and in" for k in keys[1:]])
    labelled = secret_scan.findings(documents.union(more), "text", "source").select(F.explode("candidates").alias("x"))
    model = secret_scan.train(labelled.select("x", secret_scan.known_label().alias("label")))
    key = keys[0]
    texts = [f"set {key} now", 'token = "' + "9f8e7d6c5b4a39281706" * 2 + '"', "thandthoutheringandtheother wordsinarowthatgoonandon", *ODD]
    for r in secret_scan.scan(docs_of(spark, texts).withColumn("candidates", F.lit(1)).drop("candidates"), "text", "source", model).collect():
        secrets = [r["text"][x["s"] : x["e"]] for x in r["secrets"]]
        if r["doc_id"] == 0:
            assert secrets == [key]
        elif r["doc_id"] == 1:
            assert len(secrets) == 1
        else:
            assert not secrets
    assert secret_scan.scan(docs_of(spark, [key]), "text", "source", secret_scan.Model()).first()["n_secrets"] == 0


def test_rare_secrets_are_reported(spark):
    key = "AKIA" + "Q7" * 8
    texts = [f"set {key} now", 'password = "9f8e7d6c5b4a39281706"']
    texts += [f"thandthoutheringand{chr(97 + i // 26)}{chr(97 + i % 26)} {10**15 + i}" for i in range(300)]
    docs = docs_of(spark, texts)
    labelled = secret_scan.findings(docs, "text", "source").select(F.explode("candidates").alias("x"))
    labelled = labelled.select("x", secret_scan.known_label().alias("label")).cache()
    how = secret_scan.Training(max_findings=12)

    def reported(model):
        rows = secret_scan.scan(docs, "text", "source", model).where("n_secrets > 0").collect()
        return {r["doc_id"]: [r["text"][x["s"] : x["e"]] for x in r["secrets"]] for r in rows}

    forms = ["sk_live_" + "a1" * 12, "xoxb-1234567890-abcdef", "npm_" + "b2" * 18, "github_pat_" + "c3" * 41]
    labels = secret_scan.findings(docs_of(spark, forms), "text", "source").select(F.explode("candidates").alias("x"))
    assert [r[0] for r in labels.select(secret_scan.known_label()).collect()] == [1.0] * 4
    everything = {0: [key], 1: ["9f8e7d6c5b4a39281706"]}
    rare = secret_scan.train(labelled, how)
    assert len(rare.trees) == how.trees
    found = reported(rare)
    assert {k: found.get(k) for k in everything} == everything
    for one in (0, 1):  # a single label: no trees
        model = secret_scan.train(labelled.where(F.col("label") == one), how)
        assert not model.trees and reported(model) == everything
    copies = labelled.where("label = 0 OR contains(x.m, 'AKIA')").withColumn("n", F.expr("explode(sequence(1, IF(label = 1, 9000, 1)))"))
    assert len(secret_scan.train(copies.drop("n"), how).trees) == how.trees
    never = secret_scan.Model(trees=[secret_scan.trees.Leaf(0.0)], labelled=True)
    assert reported(never) == everything
    assert reported(secret_scan.train(labelled.where("false"), how)) == everything


def test_looser_personal_data_is_added(spark):
    rng = random.Random(6)
    some = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = []
    for i in range(400):
        ip = ".".join(str(rng.randrange(10, 250)) for _ in range(4))
        texts.append(f"the w.{i}@mail{i % 9}.example.com of {ip} thand +1 ({some(3)}) 555-{some(4)} ther {some(3)} {some(4)} {some(2)} and")
    texts += [f"und ({some(3)}) 555-{some(4)} und" for _ in range(300)]  # bare phones
    texts += [f"and me{i} (at) host{i} (dot) org" for i in range(300)]
    model = pii.train(docs_of(spark, texts), "text")
    assert {"email", "ip", "phone"} <= set(model.thresholds)
    planted = [
        ("write anne (at) mail3 (dot) example (dot) com now", "email", "anne (at) mail3 (dot) example (dot) com"),
        ("write bob [at] host (dot) org now", "email", "bob [at] host (dot) org"),
        ("thand (017) 555-7713 ther", "phone", "(017) 555-7713"),
        ("of 2001:db8:85a3:1:2:8a2e:370:7334 the", "ip", "2001:db8:85a3:1:2:8a2e:370:7334"),
        ("of 2001:db8::8a2e:370:7334 the", "ip", "2001:db8::8a2e:370:7334"),
    ]
    none = ["on 2024-01-15 we", "on 2024-01-15 10:30 we", "on 15.01.2024 we", "in 2019-2020 we", "at 12:34:56 we", "mac 00:1a:2b:3c:4d:5e is", "noon (at) home"]
    docs = docs_of(spark, [t for t, _, _ in planted] + none)
    got = {r["doc_id"]: r["spans"] for r in pii.detect(docs.select("doc_id", "text"), "text", model).collect()}
    for i, (text, kind, m) in enumerate(planted):
        assert got[i] == f"{kind}:{text.index(m)}:{text.index(m) + len(m)}", text
    assert not any(got[len(planted) + i] for i in range(len(none))), got


def test_bpe_decoder_holds_tokens_alone():
    ranks = {bytes([b]): b for b in range(256)} | {b" a": 256, b" ab": 257}
    codec, decoder = bpe.Codec(ranks, public_tokenizers.PATTERN), bpe.Decoder(ranks)
    assert decoder.decode(codec.encode("x ab ab, ab")) == b"x ab ab, ab"
    assert list(vars(decoder)) == ["tokens"] and not hasattr(codec, "tokens")


def test_bpe_keeps_nothing_from_one_text_to_the_next():
    ranks = {bytes([b]): b for b in range(256)} | {b" a": 256, b" ab": 257}
    codec, rng = bpe.Codec(ranks, public_tokenizers.PATTERN), random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(6000)) for _ in range(8)]
    codec.encode(texts[0])
    tracemalloc.start()
    for text in texts[1:]:
        codec.encode(text)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 1_000_000


def test_bpe_texts_together_equal_merges_alone():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    codec, rng = bpe.Codec(ranks, public_tokenizers.PATTERN), random.Random(7)
    letters = "aabehinorst  \n\t\x1c\x85\xa0.,!?'é漢\U0001f642"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(400))) for _ in range(400)]
    texts += ["", " ", "a ", " a", "a\n b", "\na b", "ab" * 40 + " c", *("".join(rng.choices("abc", k=n)) for n in range(1, 70))]
    texts += [" ".join("".join(rng.choices("etaonrishd", k=rng.randrange(1, 70))) for _ in range(3000))]
    for text, packed in zip(texts, codec.encode_all(texts), strict=True):
        known = [i for m in codec.split(text) for i in bpe.merge(m.encode(), ranks, codec.longest)]
        assert np.frombuffer(packed, "<u4").tolist() == known, text
    assert codec.encode_all([]) == [] and codec.encode_all(["", ""]) == [b"", b""]


def test_bpe_trees_equal_merges_for_any_ranks():
    rng = random.Random(11)
    tokens = {bytes(rng.choices(b"abcd", k=rng.randrange(2, 6))) for _ in range(150)} | {bytes([b]) for b in b"abcd"}
    ranks = {t: 3 * r + 1 for r, t in enumerate(rng.sample(sorted(tokens), len(tokens)))}
    codec = bpe.Codec(ranks, r" ?\p{L}+")
    words = ["".join(rng.choices("abcd", k=rng.randrange(1, 64))) for _ in range(2000)]
    for word, packed in zip(words, codec.encode_all(words), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == bpe.merge(word.encode(), ranks, codec.longest)
    with pytest.raises(KeyError):
        codec.encode_all(["x" + w for w in words])


def test_bpe_slices_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CHARS_AT_ONCE", 10)
    rows = ["abcd", None, "é" * 4, "", "x" * 50, "y", "z" * 9, "w"]
    slices = list(bpe._slices(iter([pa.array(rows[:5]), pa.array([], pa.string()), pa.array(rows[5:])])))
    assert [r for s in slices for r in s] == rows
    assert all(sum(len((r or "").encode()) for r in s[:-1]) <= 10 for s in slices)


def test_histogram_sums_are_taken_once_a_row(spark):
    docs = spark.createDataFrame([([1, 3],), ([0, 0],), ([2, 2],)], "counts array<bigint>")
    shared = quality_rules.with_shares(docs, "counts", "shares")
    out = shared.select(F.expr("shares"), quality_rules.js_distance("shares", [1, 1]).alias("d")).collect()
    assert [r.shares for r in out] == [[0.25, 0.75], None, [0.5, 0.5]]
    assert out[2].d == 0 and 0 < out[0].d < 1
    lines = [x for x in shared._jdf.queryExecution().executedPlan().toString().splitlines() if "transform(" in x]
    assert lines and not any("aggregate(" in x.split("transform(", 1)[1].split("lambdafunction", 1)[0] for x in lines)
