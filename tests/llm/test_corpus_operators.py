"""Joins, sharding, packing, the registered queries and the pipeline against brute force."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from txspark.llm import cover_tree, ngram_join, oracle, packing, queries, sharding
from txspark.llm.components import components

duckdb = pytest.importorskip("duckdb")
public_tokenizers = pytest.importorskip("public_tokenizers")
SMALL = Path("/root/testdata/sf0.001")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, component_id string, bucket int"


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "theirs", 5) for i, t in pairs], DOCS)


def roots_of(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    expected = roots_of({x for p in links for x in p}, links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(i, i) == r for i, r in expected.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_sets(text, words=5):
    found = (text or "").translate({c: c + 32 for c in range(65, 91)})
    found = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", found) if w]
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def brute_components(pairs):
    sets = [(i, brute_sets(t)) for i, t in pairs]
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    root = roots_of([i for i, _ in pairs], links)
    return {i: (len(s), root[i]) for i, s in sets}


def near_copies(seed, families=12, copies=7):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    shared = " ".join(word() for _ in range(12))
    pairs = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice([3, 8, 40, 90]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = word()
            pairs.append((rng.randrange(10**6), " ".join(text) + rng.choice(["", "\n" + shared]) + " " * rng.randrange(2)))
    pairs = list(dict(pairs).items())
    return pairs + [(10**7 + k, t) for k, t in enumerate([None, "", " \t", "A b", "a B", "one", "É x", "é x"])]


@pytest.mark.parametrize("how", [ngram_join.Join(), ngram_join.Join(block_sets=3, block_tokens=200, pairs_up_to=1)])
def test_shingle_join_equals_brute_force(spark, how):
    pairs = near_copies(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs_of(spark, pairs), how=how).collect()}
    assert got == brute_components(pairs)


def test_shingle_join_of_repeated_and_missing_ids(spark):
    text = "a b c d e f g h"
    rows = ngram_join.near_duplicates(docs_of(spark, [(5, text), (5, text), (None, text), (None, "other words here"), (3, None)])).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in rows), key=str) == sorted([(5, 5), (5, 5), (None, 5), (None, None), (3, 3)], key=str)
    assert ngram_join.near_duplicates(docs_of(spark, [])).count() == 0
    kept = ngram_join.keep_first(docs_of(spark, [(5, text), (5, text), (9, text), (3, None), (8, "x")]))
    assert kept.columns == ["doc_id", "text", "component_id", "bucket"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 5, 8]


def test_signatures_bound_the_overlap():
    rng = np.random.default_rng(0)
    for n in (1, 5, 60, 900):
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for extra in (0, n // 5, n):
            y = np.unique(np.concatenate([x[extra // 2 :], rng.integers(0, 1 << 63, extra, dtype=np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both >= 80 * (len(x) + len(y) - both):
                assert ngram_join.may_be_similar(len(x), ngram_join.signature(x), len(y), ngram_join.signature(y), 80)


def clustered(seed, n=260, size=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, size))
    x = centres[rng.integers(0, 25, n)] + rng.normal(size=(n, size)) * rng.choice([0.05, 0.2, 0.35], (n, 1))
    x[::9] = x[0]
    return x * rng.uniform(0.01, 50, (n, 1))


def test_vector_join_equals_brute_force(spark):
    x = clustered(3)
    rows = [(1000 - i, v.tolist(), "l") for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows += [(5000 + i, v, "l") for i, v in enumerate(odd)]
    rows += [(7000, [1e-300] * 16, "l"), (7001, [1e300] * 16, "l")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, root string").repartition(3)
    for shape in (cover_tree.Shape(), cover_tree.Shape(cell=30, block=12)):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in cover_tree.near_duplicates(df, shape=shape).collect()}
        sound = {1000 - i: v / np.linalg.norm(v) for i, v in enumerate(x)} | {7000: np.full(16, 0.25), 7001: np.full(16, 0.25)}
        ids = list(sound)
        near = np.stack(list(sound.values())) @ np.stack(list(sound.values())).T >= 0.9
        links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near), strict=True) if i < j]
        root = roots_of([r[0] for r in rows], links)
        count = dict.fromkeys([r[0] for r in rows], 0)
        for a, b in links:
            count[a] += 1
            count[b] += 1
        assert got == {i: (count[i], root[i], root[i] == i) for i in count}
    assert cover_tree.near_duplicates(df.where("false")).count() == 0


def test_vectors_of_every_length_are_compared(spark):
    """Each length by itself, by brute force and by the query's SQL."""
    rng = np.random.default_rng(5)
    rows = []
    for size, n in ((16, 60), (3, 60), (2, 5), (1, 3)):
        x = clustered(size, n, size) if size > 3 else rng.normal(size=(n, size))
        rows += [(len(rows) + i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, [1.0, 0.01, 0.0]), (901, [1.0, 0.01]), (902, None), (903, []), (904, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in cover_tree.near_duplicates(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    columns = "vec_id, n_links, component_id, kept"
    told = {r[0]: r[1:] for r in con.execute(f"SELECT {columns} FROM ({oracle.COVER_TREE_DEDUP})").fetchall()}
    assert got == told
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v and np.linalg.norm(v)}
    for i, v in unit.items():
        assert got[i][0] == sum(len(u) == len(v) and u @ v >= 0.9 for j, u in unit.items() if j != i)
    assert any(n for i, (n, _, _) in got.items() if 120 <= i < 125)  # vectors of the rarer length 2


def test_sharding(spark):
    rng = random.Random(6)
    texts = ["copy " * 9] * 400 + ["w " * rng.randrange(1, 400) + str(i) for i in range(700)] + [None, "", "x" * 3000, "é漢"]
    df = docs_of(spark, list(enumerate(texts)) + [(3, "copy " * 9), (None, "no id")])
    rows = sharding.shard_documents(df).collect()
    assert len(rows) == len(texts) + 2
    sizes, groups = {}, {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        groups.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert set(sizes) == set(range(8))
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * max(sizes.values())
    hot = (46, zlib.crc32(b"copy " * 9))
    assert all(len(s) == 1 for g, s in groups.items() if g != hot)
    for shard in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    by_id = {r["doc_id"]: r for r in rows}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        assert (by_id[i]["size"], by_id[i]["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    assert sharding.shard_documents(df.where("false")).count() == 0


def test_plan_uses_up_any_histogram():
    rng = np.random.default_rng(8)
    cases = [{7: 3}, {2048: 4, 1: 1}, {1500: 1000, 548: 999, 3: 7}, {1: 5000}]
    lengths = rng.integers(1, 2048, 20_000)
    cases.append(dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True)), strict=True)))
    for histogram in cases:
        used = {}
        chosen = packing.plan(histogram, 2048)
        for pattern, count in chosen:
            assert sum(pattern) <= 2048 and count > 0
            for x in pattern:
                used[x] = used.get(x, 0) + count
        assert used == histogram
    least = -(-int(lengths.sum()) // 2048)
    assert sum(c for _, c in chosen) <= least * 1.01


@pytest.mark.parametrize(("low", "high", "most"), [(20, 300, 1.001), (1, 30, 1.001), (300, 900, 1.02)])
def test_fitted_patterns_place_short_pieces(low, high, most):
    lengths = np.random.default_rng(9).integers(low, high, 60_000)
    histogram = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True)), strict=True))
    left = dict(histogram)
    fitted = packing.fitted_patterns(left, 2048)
    assert sum(left.values()) < 0.1 * len(lengths)
    assert sum(len(p) * c for p, c in fitted) + sum(left.values()) == len(lengths)
    assert sum(c for _, c in packing.plan(histogram, 2048)) <= most * (int(lengths.sum()) / 2048) + 1


def test_packing_query_equals_brute_force(spark):
    """All columns of the query but the places, and the places by their law."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = set()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        extra = -(-len(ids) // 2048) - 1
        at = [0, *range(len(ids) - 2048 * extra, len(ids), 2048), len(ids)] if extra else [0, len(ids)]
        for k, (a, b) in enumerate(zip(at, at[1:])):
            expected.add((r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    rows = queries.op5_packing(spark, str(SMALL)).collect()
    assert {tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows} == expected
    assert len(rows) == len(expected)
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["thand", "of,", "été", "x1", "a\n b"]) for _ in range(rng.randrange(1500))) for _ in range(120)]
    texts += [None, "", "w " * 9000, "<|endoftext|> 's", " lead", "trail ", "漢字" * 50, "same"] + ["same"] * 40
    rows = packing.pack_documents(docs_of(spark, enumerate(texts)), TOKENIZER, 512).collect()
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    total = 0
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        mine = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert len(mine) == -(-len(ids) // 512)
        at = 0
        for r in mine:
            assert r["start"] == at
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
            assert r["piece"] == 0 or r["length"] == 512
        assert at == len(ids)
    assert len(sequences) <= -(-total // 512) + 2
    assert packing.pack_documents(docs_of(spark, []), TOKENIZER, 512).count() == 0


@pytest.fixture(scope="module")
def tables():
    if not SMALL.exists():
        pytest.skip("needs the given tables")
    con = duckdb.connect()
    for file in SMALL.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


COLUMNS = {
    "op1_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op2_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op3_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op4_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op5_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op6_ngram_jaccard_join": {"doc_id", "n_shingles", "component_id"},
    "op7_cover_tree_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op8_secret_scan": {"doc_id", "n_candidates", "n_secrets", "secrets"},
    "op9_factorisation_machine": {"doc_id", "held_out", "score", "predicted"},
    "op10_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op11_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op12_embedding_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    "op13_periodic_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
    "pipeline": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
}


def test_all_queries_are_listed():
    assert set(queries.queries()) == set(COLUMNS)
    assert set(oracle.oracle_sql()) <= set(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, tables, name):
    df = queries.queries()[name](spark, str(SMALL))
    assert COLUMNS[name] <= set(df.columns)
    rows = df.collect()
    table = "embeddings" if name.startswith(("op7", "op12")) else "documents"
    count = tables.execute(f"SELECT count(*) FROM {table}").fetchall()[0][0] * (32 if name.startswith("op12") else 1)
    if name not in ("op5_packing", "pipeline"):
        assert len(rows) == count
    if sql := oracle.oracle_sql().get(name):
        columns = sorted(df.columns)
        expected = tables.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(repr(tuple(r[c] for c in columns)) for r in rows) == sorted(map(repr, expected))


def test_pipeline_stages(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = docs.withColumn("guess", F.lit("g")).withColumn("kept", F.lit(1))
    before = extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, str(SMALL)).cache()
        assert after.columns == before.columns, name
        assert 0 < after.count() <= before.count()
        before = after
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    sets = brute_components([(i, t) for i, t in texts.items()])
    assert sum(root != i for i, (_, root) in sets.items()) <= 2  # redaction may bring texts together
    packed = corpus_pipeline.STAGES[-1][1](spark, before, str(SMALL)).collect()
    assert {r["doc_id"] for r in packed} == set(texts)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), str(SMALL)).count() == 0


def test_added_tokens_get_their_ids(spark, tmp_path):
    from tokenizers import Tokenizer

    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a  b<|endoftext|><|endoftext|> c\n" * 900, "<|endoftext| > plain", "plain"]
    docs_of(spark, enumerate(texts)).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for df in (queries.op5_packing(spark, str(tmp_path)), corpus_pipeline.packed_sequences(spark, docs, str(tmp_path))):
        got = {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"]) for r in df.collect()}
        for i, text in enumerate(texts):
            ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
            parts = sorted((start, *value) for (doc, start), value in got.items() if doc == i)
            assert sum(n for _, n, _ in parts) == len(ids)
            assert [c for _, _, c in parts] == [zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes()) for a, n, _ in parts]


def test_chunk_cache_holds_the_words_of_several_rounds():
    made = []
    cache = packing._Cache(lambda t: made.append(t) or b"", packing.CHUNK_ENTRIES)
    for _ in range(2):
        for i in range(300_000):
            cache[str(i)]
    assert len(made) == 300_000
