"""URL classes, components, embeddings and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from abx.llm import embedding, langid, queries, toxicity, url_filter
from abx.llm.components import connected_components
from abx.llm.queries import URL_RULES
from conftest import SF001
from oracle_compare import compare, duck
from test_llm_text import brute_cut, brute_fingerprint, brute_language, close, components


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    ok, detail = compare(spark, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF001, duck(SF001))
    assert ok, detail


@pytest.mark.parametrize("shape", ["path", "star", "random", "copies"])
def test_components(spark, shape):
    rng = random.Random(7)
    pairs = {"path": [(i, i + 1) for i in range(200)], "star": [(500, i) for i in range(300)],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(300)],
             "copies": [(1, 2)] * 50 + [(2, 1), (3, 3), (None, 4), (5, None)]}[shape]
    rng.shuffle(pairs)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
    assert got == components({x for p in real for x in p}, real)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 urls -----------------------------------------------------------------

def test_url_classes(spark):
    rows = [(1, "https://a.org/x", '<link rel="canonical" href="https://e.net/es/1">'),      # its target is blocked
            (2, "https://b.org/y#f", "<META http-equiv=Refresh content='0; URL=/z'>"),
            (3, "http://b.org/z", '<link href=https://a.org/x rel="canonical">'),
            (4, None, None),
            (5, "https://c.org/q", '<!-- <link rel=canonical href="https://a.org/x"> -->'),
            (6, "https://d.org/q?a=1", '<link rel=canonical href="https://s.com/x"><link rel=canonical href="https://w.net/fr/x">'),
            (7, "nothing", "x"), (8, "https://w.net/fr/x", ""), (9, "https://F.org/a/b?p", '<link rel="canonical" href="c">'),
            (10, "https://f.org/a/c", '<link rel="canonical" href="mailto:x"><link rel="icon" href="https://e.net/es/1">'),
            (11, "http://x.Example.com/en/1?q#h", ""), (12, "http://www.example.com/en/", ""), (13, "https://y.com", ""),
            (13, "https://y.com", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    moved = spark.createDataFrame([("https://f.org/a/c", "https://e.net/es/9"), (None, "x")], "from_url string, to_url string")
    got = {r.page_id: r for r in url_filter.judge_urls(df, URL_RULES, redirects=moved).collect()}
    verdict = {k: (r.rule, r.verdict) for k, r in got.items()}
    assert verdict == {
        1: (None, "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "allow"), 5: (None, "allow"),
        6: (None, "allow"),                 # its class holds an allowed and a blocked url: allow goes first
        7: (None, "allow"), 8: ("net/fr/", "block"), 9: (None, "block"), 10: (None, "block"),
        11: ("example.com/en/", "block"), 12: ("www.example.com/en/", "allow"), 13: (None, "allow")}
    assert (got[11].host, got[11].path) == ("x.example.com", "/en/1") and (got[4].host, got[7].path) == ("", "")
    assert url_filter.judge_urls(df, URL_RULES).count() == 14
    assert url_filter.judge_urls(df.where("false"), URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(df, [], html_col=None).collect()} == {"allow"}


# --- 10 embeddings ------------------------------------------------------------

def brute_links(vectors, threshold=0.95):
    x = np.array([v for _, v in vectors], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    ids = [i for i, _ in vectors]
    root = components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a < b])
    return {i: (int(n), root[i]) for i, n in zip(ids, near.sum(axis=1))}


def test_embeddings_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding, "SLOTS", 40)         # so that hot buckets are split in blocks
    monkeypatch.setattr(embedding, "CHUNK_ROWS", 50)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 24))
    near = [base[k % 30] + rng.normal(size=24) * 0.12 for k in range(120)] + [base[0] + rng.normal(size=24) * 0.03 for _ in range(150)]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate([*base, *near])]
    rows += [(1000 + k, rows[5][1]) for k in range(30)] + [(2000, [2 * x for x in rows[5][1]])]
    bad = [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [float("nan")] + [1.0] * 23), (3004, [float("inf")] + [1.0] * 23),
           (3005, [None] + [1.0] * 23), (None, rows[5][1]), (3006, rows[5][1][:8])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<float>, rep int").repartition(3)
    got = {r.vec_id: r for r in embedding.near_duplicates(df).collect()}
    assert len(got) == len(rows) + len(bad)
    want = brute_links(rows)
    found = sum(got[i].n_links for i in want)
    assert found >= 0.97 * sum(n for n, _ in want.values()) and all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(got[i].component_id == c for i, (_, c) in want.items()) >= 0.97 * len(want)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i, _ in bad)
    assert all(r.kept == (r.vec_id == r.component_id) for i, r in got.items() if i is not None)
    assert embedding.near_duplicates(df.where("false")).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    for total in (1000, 1_000_000):
        how = embedding.plan(total, [64], 0.95)
        assert embedding.meet(*embedding.keys_of(a, how), *embedding.keys_of(b, how)).any(axis=1).mean() >= 0.98


def test_keys_are_shortened_where_pairs_meet_too_seldom():
    assert embedding.plan(250, [64], 0.95) == embedding.Hashing(12, embedding.plan(250, [64], 0.95).tables)
    how = embedding.plan(10 ** 9, [64], 0.6)
    assert 2 < how.bits < 34
    p = embedding.chance(64, how.bits, 0.6)
    assert p >= embedding.LEAST_CHANCE and 1 - (1 - p) ** how.tables >= 0.995


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(embedding._hadamard(x), axis=1), 4 * np.linalg.norm(x, axis=1))


# --- pipeline -----------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = spark.createDataFrame([(90001, None), (90002, ""), (90003, "123"), (None, "this is the and that of it with words")],
                                  "doc_id long, text string")
    rows = docs.unionByName(extra, allowMissingColumns=True).withColumn("found", F.lit(1)).withColumn("n_words", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        before = rows
        rows = corpus_pipeline.written(stage(spark, rows, SF001), name)
        if name != "packing":
            assert rows.columns == before.columns and rows.dtypes == before.dtypes
        left = {r.doc_id: r.text for r in before.collect()}
        if name == "language":
            assert not {90001, 90002, 90003} & {r.doc_id for r in rows.collect()}
            assert rows.count() >= 0.97 * docs.count()
        if name == "near_duplicates":
            fp = {i: brute_fingerprint(t) for i, t in left.items()}
            root = components(set(fp.values()), close(np.unique(np.array(list(fp.values()), np.uint64))))
            least = {}
            for i, f in fp.items():
                if i is not None:
                    least[root[f]] = min(i, least.get(root[f], i))
            assert {r.doc_id for r in rows.collect()} == {i for i, f in fp.items() if i is None or least[root[f]] == i}
        if name == "repeated_passages":
            want = {i: t for i, _, _, t in brute_cut(list(left.items()))}
            assert {r.doc_id: b" ".join((r.text or "").encode().split()) for r in rows.collect()} == want
        if name == "packing":
            assert {r.doc_id for r in rows.collect()} == set(left)
            fill = Counter()
            for r in rows.collect():
                fill[r.sequence_id] += r.length
            assert max(fill.values()) <= 2048
    assert corpus_pipeline.run(spark, SF001).columns == rows.columns


def brute_toxicity(text, model):
    """Score of one text, a word at a time."""
    weights = dict(zip(model.features.tolist(), model.weights.tolist()))
    held, tokens, quarter = Counter(), (text or "").split(), toxicity.Settings.buckets // 4
    for token in tokens:
        ids = set()
        for word in re.findall(r"[^\W\d_]+", token.lower()):
            ids |= {zlib.crc32(b"=" + word.encode()) % quarter}
            ids |= {zlib.crc32(b"^" + word[:n].encode()) % quarter for n in (4, 5, 6) if len(word) >= n}
        held.update(ids)
    n, g = max(50, len(tokens)), model.bias
    for i, k in held.items():
        for tier, (times, share) in enumerate(((1, 0), (2, 200), (3, 100))):
            if k >= times and (not share or share * k >= n):
                g += weights.get(4 * i + tier, 0.0)
    return 1 / (1 + math.exp(-g)) if g > -700 else 0.0


def brute_posterior(text, model):
    """Language and posterior of one text; none without a letter."""
    if not regex.search(r"\p{L}", text or ""):
        return "und", 0.0
    s = brute_language(text, model)
    p = np.exp(s - s.max())
    return model.langs[int(p.argmax())], float(p.max() / p.sum())


def brute_kept_text(text, window=50, gone=()):
    """The text less the words at these places, each with the white space up to the next word."""
    starts = [m.start() for m in re.finditer("[^\x20\x09-\x0D]+", text)] + [len(text)]
    return text[:starts[0]] + "".join(text[a:b] for i, (a, b) in enumerate(zip(starts, starts[1:])) if i not in gone)


def brute_pieces(text, library, size=2048):
    ids = library.encode(text, add_special_tokens=False).ids + [0]
    first = (len(ids) - 1) % size + 1
    ends = list(range(first, len(ids) + 1, size))
    return [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip([0, *ends], ends))]


def test_language_and_toxicity_rows_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    for r in queries.op3_language_id(spark, SF001).collect():
        lang, score = brute_posterior(texts[r.doc_id], model)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-6
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs.where(~held), spark.read.parquet(f"{SF001}/labels.parquet").where(~held))
    for r in queries.op5_toxicity(spark, SF001).collect():
        score = brute_toxicity(texts[r.doc_id], model)
        assert abs(r.score - score) < 1e-9 and r.predicted == (r.score >= 0.5)


def test_pipeline_rows_equal_a_chain_of_brute_force(spark, tmp_path):
    """run(), row by row, over documents of which a third are copies of one."""
    base = spark.read.parquet(f"{SF001}/documents.parquet")
    first = base.orderBy("doc_id").limit(1)
    copies = first.crossJoin(spark.range(base.count() // 2).withColumnRenamed("id", "copy")).withColumn(
        "doc_id", F.col("copy") + 70000).drop("copy")
    odd = spark.createDataFrame([(90001, None), (90002, ""), (90003, "123")], "doc_id long, text string")
    base.unionByName(copies).unionByName(odd, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF001}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}

    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    left = {i: t for i, t in texts.items() if brute_posterior(t, model)[1] >= 0.5}
    held = toxicity.held_out(F.col("doc_id"))
    here = docs.where(F.col("doc_id").isin(list(left)) & ~held)
    model = toxicity.fit(here, spark.read.parquet(f"{tmp_path}/labels.parquet").where(~held))
    scores = {t: brute_toxicity(t, model) for t in set(left.values())}
    left = {i: t for i, t in left.items() if scores[t] < 0.5}
    prints = {t: brute_fingerprint(t) for t in set(left.values())}
    root = components(set(prints.values()), close(np.unique(np.array(list(prints.values()), np.uint64))))
    least = {}
    for i, t in left.items():
        least[root[prints[t]]] = min(i, least.get(root[prints[t]], i))
    left = {i: t for i, t in left.items() if least[root[prints[t]]] == i}
    words = {i: re.findall("[^\x20\x09-\x0D]+", t) for i, t in left.items()}
    owner = {}
    for i, w in words.items():
        for a in range(len(w) - 49):
            owner[tuple(w[a:a + 50])] = min(i, owner.get(tuple(w[a:a + 50]), i))
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    want = set()
    for i, w in words.items():
        gone = {b for a in range(len(w) - 49) if owner[tuple(w[a:a + 50])] < i for b in range(a, a + 50)}
        want |= {(i, *p) for p in brute_pieces(brute_kept_text(left[i], gone=gone), library)}
    assert len(left) < len(texts) - base.count() // 2 and len(left) > 0.5 * base.count()

    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(rows) == len(want) and {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert ends[-1] <= corpus_pipeline.SEQUENCE and ends[:-1] == [a for a, _ in sorted(parts)]
