"""Text operators of abx.llm against brute-force versions and the tokenizer libraries."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from abx.llm import bpe, langid, packing, quality, queries, simhash, substring, token_counts, tokens, toxicity
from conftest import SF001

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "B", "é", "1", "٣", " ", "  ", "\n", "\n\n", "\t", "\r\n", "'s", "'", "!", "…", "中", "文", "<|endoftext|>", "\x1c",
       "\x85", "\xa0", " ", "_", "-", "́", "😀", "²", "Ⅷ", "​", "the", " the", "aaaa", "    ", "ing", "==="]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}


def odd_texts(n, seed=5, most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, most))) for _ in range(n)]


# --- 2 packing --------------------------------------------------------------

def test_units_encode_like_the_library(library):
    texts = odd_texts(1500)
    got = tokens.encode_all(texts, tokens.library_units(library), {})
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_packing_holds_every_piece_once(spark, library, docs):
    rows = queries.op2_best_fit_packing(spark, SF001).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = 0
    for doc, text in docs.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for k, r in enumerate(sorted(by_doc[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 2048)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
        total += at
    assert len(by_sequence) <= -(-total // 2048) * 1.01 + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_close_to_the_bound_and_consistent(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(64, rng.lognormal(rng.uniform(1, 3), 1.0, rng.integers(1, 3000)).astype(int) + 1)
    counts = Counter(lengths.tolist())
    runs, bins = packing.plan_packing(counts, 64)
    fill, seen = Counter(), Counter()
    places = defaultdict(list)
    for r in runs:
        assert r.rank == seen[r.length]
        seen[r.length] += r.bins * r.each
        for b in range(r.first, r.first + r.bins):
            fill[b] += r.length * r.each
            places[b] += [(r.offset + k * r.length, r.length) for k in range(r.each)]
    assert seen == counts and len(fill) == bins and max(fill.values()) <= 64
    for p in places.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(p), sorted(p)[1:]))
    assert bins <= -(-int(lengths.sum()) // 64) * 1.03 + 3


def test_index_of_sums_under_removal():
    rng = random.Random(3)
    for size in (5, 12, 40):
        live = set(rng.sample(range(1, size + 1), rng.randint(1, size)))
        index = packing._Sums(live, size)
        while live:
            for total in range(1, size + 1):
                pairs = [a for a in sorted(live, reverse=True) if total - a in live and 2 * a >= total]
                triples = [(a, b) for a in sorted(live, reverse=True) for b in sorted(live, reverse=True)
                           if total - a - b in live and a >= b >= total - a - b]
                assert (index.two[total], index.three[total]) == (len(pairs), len(triples))
                assert index.pairs(total) == pairs and list(index.triples(total)) == triples
            gone = rng.choice(sorted(live))
            live.remove(gone)
            index.drop(gone)
            index.drop(gone)


def test_exact_complements_are_used():
    runs, bins = packing.plan_packing({1500: 2, 548: 1, 300: 1, 248: 1, 1000: 1, 500: 1, 400: 1, 148: 1}, 2048)
    assert bins == 3    # 1500+548, 1500+300+248, 1000+500+400+148


# --- 3 language -------------------------------------------------------------

def test_language_on_held_out_documents(spark):
    rows = queries.op3_language_id(spark, SF001).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held) > 0


def test_language_edges(spark):
    rows = [(1, "der und die das ist nicht", "de"), (2, "the and of that is not", "en"), (3, None, "en"), (4, "", None),
            (5, "123 !!", "de"), (6, "the and that", None), (6, "the and that", None), (None, "und die", None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, langid int")
    found = langid.identify(df, df)
    got = {(r.doc_id, r.text): r[-1] for r in found.collect()}
    assert found.count() == len(rows)
    assert [got[k, t].lang_pred for k, t in ((3, None), (4, ""), (5, "123 !!"))] == ["und"] * 3
    assert got[6, "the and that"].lang_pred == "en" and got[None, "und die"].lang_pred == "de"
    assert all(0 <= x.score <= 1 for x in got.values())
    nothing = langid.identify(df, df.where("false")).collect()
    assert {r[-1].lang_pred for r in nothing} == {"und"}
    assert langid.identify(df.where("false"), df).count() == 0


def brute_language(text, model):
    """Log joint scores, an n-gram at a time."""
    padded, buckets, mask = f" {text.lower()} ", len(model.weights) - 1, (1 << 64) - 1
    score = model.prior.astype(float).copy()
    for n in langid.ORDERS:
        for i in range(len(padded) - n + 1):
            h = 0x9E3779B97F4A7C15 * n & mask
            for c in padded[i:i + n]:
                h = (h ^ ord(c)) * 0xFF51AFD7ED558CCD & mask
                h ^= h >> 32
            score += model.weights[h % buckets].astype(float)
    return score


def test_language_scores_equal_brute_force_wherever_texts_are_cut(monkeypatch):
    rng = random.Random(6)
    model = langid.Model(("a", "b", "c"), np.log([0.5, 0.3, 0.2]), np.random.default_rng(1).normal(size=(258, 3)).astype(np.float32) * 0.1)
    model.weights[-1] = 0
    texts = ["", "a", "ab", "İ", *("".join(rng.choice("abc dé\n😀ßΣ") for _ in range(rng.randrange(1, 90))) for _ in range(60))]
    want = np.array([brute_language(t, model) for t in texts])
    assert np.allclose(langid.log_scores(texts, model), want, atol=1e-6)
    for block in (3, 7, 10, 64):
        monkeypatch.setattr(langid, "BLOCK", block)
        assert np.allclose(langid.log_scores(texts, model), want, atol=1e-6)


def test_language_letters():
    model = langid.Model(("a",), np.zeros(1), np.zeros((129, 1), np.float32))
    assert langid.predict(["² ½ 10", "٣", "Ⅳ", "ª", "漢", "é1", "_ "], model)[0] == ["und", "und", "und", "a", "a", "a", "und"]


def test_language_result_does_not_depend_on_neighbours():
    model = langid.Model(("a", "b"), np.log([0.5, 0.5]), np.random.default_rng(0).normal(size=(129, 2)).astype(np.float32) * 0.01)
    model.weights[-1] = 0
    texts = ["x", "hello world", "ä" * 50, "zz top"]
    alone = [langid.log_scores([t], model)[0] for t in texts]
    assert np.allclose(langid.log_scores(texts, model), alone)


# --- 4 BPE ------------------------------------------------------------------

def test_bpe_like_the_library(library):
    texts = odd_texts(1500) + ["", "ab" * 300, "aaa" * 101, " " * 57 + "x"]
    got = bpe.encode_texts(texts, PATH)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in got] == [e.ids for e in want]
    v = bpe.read_vocabulary(PATH)
    assert [bpe.decode_ids(x, v).decode() for x in got] == texts
    pieces = [x[:len(x) // 2] for x in got[:300]]       # ids that may end within a character
    assert [bpe.decode_ids(x, v).decode("utf-8", "replace") for x in pieces] == [
        library.decode(x.tolist(), skip_special_tokens=False) for x in pieces]


def test_bpe_splits_every_character_like_the_library(library):
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}1{c} {c}{c}.{c}\n" for c in chars]
    got = bpe.encode_texts(texts, PATH)
    assert [x.tolist() for x in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_bpe_query(spark, library, docs):
    for r in queries.op4_bpe_round_trip(spark, SF001).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# --- 5 toxicity -------------------------------------------------------------

def test_toxicity_finds_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op5_toxicity(spark, sf).collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) >= 0.85
    assert np.mean([n < 0.5 for n in neg]) >= 0.95


def test_toxicity_edges(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(400)]
    rows = []
    for i in range(400):
        t = [rng.choice(words) for _ in range(20)]
        if i % 8 == 0:
            t[3] = t[9] = "horribleword"
        rows.append((i, " ".join(t), i))
    df = spark.createDataFrame(rows + [(1000, None, 0), (1001, "", 0), (None, "horribleword, horribleword", 0)],
                               "doc_id long, text string, f int")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(200)] + [(0, 0), (None, 1), (5, None)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    got = df.select("doc_id", toxicity.scorer(spark, model)(F.col("text")).alias("s")).collect()
    assert len(got) == 403
    for r in got:
        toxic = r.doc_id is None or (r.doc_id < 1000 and r.doc_id % 8 == 0)
        assert (r.s >= 0.5) == toxic
    none = toxicity.fit(df, labels.where("false"))
    assert {r.s for r in df.select(toxicity.scorer(spark, none)(F.col("text")).alias("s")).collect()} == {0.0}


def test_nnpu_beats_treating_unlabelled_as_negative():
    rng = np.random.default_rng(3)
    pos = [np.sort(np.append(rng.choice(1000, 30, replace=False), 4000 + k % 3)) for k in range(300)]
    unl = [np.sort(rng.choice(1000, 30, replace=False)) for _ in range(600)] + pos[:300:2]
    m = toxicity.fit_nnpu(pos, unl, 0.2, toxicity.Settings(buckets=8192))
    weights = dict(zip(m.features.tolist(), m.weights.tolist()))
    assert set(weights) >= {4000, 4001, 4002}
    assert all(m.bias + weights[f] > 0 for f in (4000, 4001, 4002)) and m.bias < 0


@pytest.mark.parametrize("toxic", [0, 1])
def test_toxicity_with_a_large_group_of_copies(spark, scratch, toxic):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    alone = docs.join(labels.where(F.col("toxic") == toxic), "doc_id").where(~toxicity.held_out(F.col("doc_id")))
    text = alone.where("length(text) between 1000 and 2000").orderBy("doc_id").first().text
    n = labels.count()      # as many copies again: half of the labelled rows
    ids = spark.range(10_000_000, 10_000_000 + n).toDF("doc_id")
    docs.unionByName(ids.withColumn("text", F.lit(text))).write.parquet(f"{scratch}/documents.parquet")
    labels.unionByName(ids.withColumn("toxic", F.lit(toxic).cast(labels.schema["toxic"].dataType))).write.parquet(
        f"{scratch}/labels.parquet")
    want = {r.doc_id: r.predicted for r in queries.op5_toxicity(spark, sf).collect()}
    got = {r.doc_id: r.predicted for r in queries.op5_toxicity(spark, scratch).collect()}
    assert len(got) == len(want) + n and {i: got[i] for i in want} == want
    assert {got[i] for i in got if i not in want} == {toxic}
    kept = corpus_pipeline.toxic(spark, spark.read.parquet(f"{scratch}/documents.parquet"), scratch)
    assert {r.doc_id for r in kept.collect()} == {i for i in got if not got[i]}


def test_units_are_copies_and_not_texts_of_common_words(spark):
    rng = random.Random(6)
    common = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(common) for _ in range(60)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(300 + i, t.upper().replace(" ", "\n")) for i, t in enumerate(texts)]
    rows += [(600, "of"), (601, "of the"), (602, "of the and"), (603, ""), (604, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", toxicity.unit_of(F.col("text")).alias("k"))
    got = {r.doc_id: r.k for r in df.collect()}
    assert len({got[i] for i in range(300)}) == 300 and all(got[i] == got[300 + i] for i in range(300))
    assert len({got[600 + i] for i in range(4)}) == 4 and got[603] == got[604]


# --- 6 quality --------------------------------------------------------------

def brute_quality(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_quality_counts(spark, docs):
    rng = random.Random(2)
    extra = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(60)] + odd_texts(60)
    rows = [*docs.items(), (None, None), (-1, ""), (-2, "a b " * 3000)] + [(10_000 + i, t) for i, t in enumerate(extra)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n_words int, c int")
    want = dict(rows)
    for r in quality.with_quality(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(want[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_lines(spark):
    # No two lines share eight words in a row: repeated windows fail a text by themselves.
    prose = "\n".join(f"Line {w} tells of {w} roads, {w} rivers and {w} towns that honest people built." for w in
                      ("one", "two", "three", "four", "five", "six", "seven", "eight"))
    nav = "\n".join("Home | About | News | Contact | Blog" for _ in range(3))
    rows = [(1, prose), (2, prose + "\nAll rights reserved.\n" + nav), (3, "\n".join(["red | blue | green | gold | pink"] * 2
            + [f"alpha{i} | beta{i} | gamma{i} | delta{i} | eps{i}" for i in range(12)]))]
    got = {r.doc_id: r for r in quality.with_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].clean_text == prose
    assert got[2].clean_text == prose
    assert not got[3].kept and got[3].clean_text == ""


# --- 7 SimHash --------------------------------------------------------------

def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def close(fps, distance=3):
    return [(int(fps[i]), int(fps[i + 1 + k])) for i in range(len(fps))
            for k in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= distance)]


def flipped(rng, fps, bits):
    for _ in range(bits):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, len(fps), dtype=np.uint64))
    return fps


def test_tree_brings_every_close_pair_together():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 1500, dtype=np.uint64) * np.uint64(2)
    near = [flipped(rng, base[rng.integers(0, 1500, 900)], b) for b in (1, 2, 3, 4)]
    ball = flipped(rng, np.full(1200, base[0]), 3)
    fps = np.unique(np.concatenate([base, *near, ball]))
    tree = simhash.plan_tree(rng.choice(fps, 600, replace=False), len(fps), 3, shard=500)
    shard, member = simhash.route(fps, tree, 3)
    assert len(np.unique(shard)) > 8
    edges = [(int(a), int(b)) for s in np.unique(shard) for a, b in zip(*simhash.forest(np.unique(member[shard == s]), 3))]
    want = components(fps.tolist(), close(fps))
    assert components(fps.tolist(), edges) == want
    assert components(fps.tolist(), [(int(a), int(b)) for a, b in zip(*simhash.forest(fps, 3))]) == want


def shard_numbers(node):
    if isinstance(node, simhash.Leaf):
        return node.shards
    return shard_numbers(node.inner) + shard_numbers(node.outer)


def test_a_ball_that_no_split_helps_is_dealt_into_block_pairs():
    rng = np.random.default_rng(2)
    fps = np.unique(flipped(rng, np.full(4000, np.uint64(12345)), 2))       # all within four bits of each other
    tree = simhash.plan_tree(fps, len(fps), 3, shard=200)
    shard, member = simhash.route(fps, tree, 3)
    held = Counter(shard.tolist())
    assert len(held) > 20 and max(held.values()) <= 400
    edges = [(int(a), int(b)) for s in held for a, b in zip(*simhash.forest(np.unique(member[shard == s]), 3))]
    assert components(fps.tolist(), edges) == components(fps.tolist(), close(fps))


@pytest.mark.parametrize("total", [900, 9_296, 250_000])
def test_every_size_goes_through_a_tree(total):
    fps = np.unique(np.random.default_rng(total).integers(0, 1 << 63, total, dtype=np.uint64))
    tree = simhash.plan_tree(fps[::10], total, 3, simhash.shard_size(total))
    assert isinstance(tree, simhash.Node) and shard_numbers(tree) >= 4
    shard, member = simhash.route(fps, tree, 3)
    assert max(Counter(shard.tolist()).values()) < 3 * simhash.shard_size(total)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_all_pairs(spark, docs):
    rows = [*docs.items(), (90001, None), (90002, ""), (90003, " \n"), (None, "one two"), (90004, "ONE two"), (90004, "ONE two")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, fp int")
    got = simhash.near_duplicates(df).select("doc_id", simhash.hex_of(F.col("fp")).alias("h"), "component_id").collect()
    fp = [(i, brute_fingerprint(t)) for i, t in rows]
    root = components({f for _, f in fp}, close(np.unique(np.array([f for _, f in fp], np.uint64))))
    least = {}
    for i, f in fp:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r) for r in got], key=key) == sorted([(i, f"{f:016x}", least[root[f]]) for i, f in fp], key=key)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, f in fp if i is None or least[root[f]] == i)
    assert simhash.near_duplicates(df.where("false")).count() == 0


# --- 8 substring ------------------------------------------------------------

def brute_cut(rows, window=50):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for a in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[a:a + window])
                first[k] = min(i, first.get(k, i))
    out = []
    for i, w in words:
        gone = set()
        for a in range(len(w) - window + 1):
            if i is not None and first[tuple(w[a:a + window])] < i:
                gone.update(range(a, a + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("hot", [150_000, 200])
def test_substring_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(70)) for _ in range(3)]
    rows = []
    for i in range(150):
        t = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))
        for _ in range(rng.randint(0, 2)):
            t += rng.choice([" ", "\n", "  ", "\t", "\x1c "]) + rng.choice(passages) + " " + " ".join(
                rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))
        rows.append((i, t))
    rows += [(500 + i, rows[i * 7][1]) for i in range(20)] + [rows[3], (900, None), (901, ""), (None, passages[0]),
             (902, "same " * 400), (903, "same " * 200)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                               "doc_id long, text string, n_words int, `_wanted` string").repartition(4)
    cut = substring.remove_repeats(df)
    assert cut.columns == [*df.columns, "n_words_", "n_removed"]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r["n_words_"], r.n_removed, b" ".join((r.text or "").encode().split()))
                  for r in cut.collect()))
    assert got == sorted((i is None, i or 0, n, k, t) for i, n, k, t in brute_cut(rows))
    by_id = {r.doc_id: r.text for r in cut.collect()}
    assert by_id[900] is None and by_id[901] == ""
    assert all(by_id[i] == t for (i, t), (_, _, k, _) in zip(rows, brute_cut(rows)) if k == 0 and i is not None)
    assert substring.remove_repeats(df.where("false")).count() == 0


@pytest.mark.parametrize("kind", ["long", "string", "short"])
def test_substring_splits_by_words(spark, monkeypatch, kind):
    """Few super-k-mers, each as long as its document: windows travel by themselves, each once a document."""
    monkeypatch.setattr(substring, "HOT", 1000)
    monkeypatch.setattr(substring, "BLOCK", 1 << 14)
    rng = random.Random(12)
    turn = " ".join(f"t{i}" for i in range(7))
    rows = [(1, "same " * 3000), (2, "same " * 2500 + "end " + "same " * 700), (3, (turn + " ") * 600), (4, "lead " + (turn + " ") * 500),
            (5, " ".join(f"w{rng.randrange(9000)}" for _ in range(3000))), (4, "same " * 90), (6, "same " * 60)]
    if kind == "string":
        rows = [(str(i), t) for i, t in rows]
    cut = substring.remove_repeats(spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3))
    got = sorted((r.doc_id, r.n_words, r.n_removed, b" ".join((r.text or "").encode().split())) for r in cut.collect())
    assert got == sorted(brute_cut(rows))


def test_substring_refuses_other_ids(spark):
    with pytest.raises(ValueError, match="double"):
        substring.remove_repeats(spark.createDataFrame([(1.5, "x")], "doc_id double, text string"))


def rows_out(plan, kind):
    """Rows that the plan's nodes of a kind gave, after it ran."""
    name = plan.getClass().getSimpleName()
    below = ([plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec")
             else [plan.children().apply(i) for i in range(plan.children().size())])
    mine = [plan.metrics().apply("pythonNumRowsReceived").value()] if name.startswith(kind) else []
    return mine + [n for p in below for n in rows_out(p, kind)]


def test_substring_rows_that_repeat_a_document(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(5000)}" for _ in range(3000)]
    other = list(words)
    other[25::60] = ["x"] * len(other[25::60])     # minimisers are shared, super-k-mers are not all equal
    rows = [(1, " ".join(other))] + [(2, " ".join(words))] * 30
    cut = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = sorted((r.doc_id, r.n_words, r.n_removed, b" ".join((r.text or "").encode().split())) for r in cut.collect())
    assert got == sorted(brute_cut(rows)) and got[-1][2] > 0
    assert max(rows_out(cut._jdf.queryExecution().executedPlan(), "MapInArrow")) < 30 * 30


def test_substring_line_that_many_documents_repeat(spark, monkeypatch):
    """Single windows of a common line become one span a document, however often it stands there."""
    monkeypatch.setattr(substring, "HOT", 1000)
    assert substring.merged([7, 1, 3, 3, 20], 5) == [(1, 11), (20, 5)]
    assert substring.merged([0, 5, 11], 5) == [(0, 10), (11, 5)]
    line = " ".join(f"t{i}" for i in range(12))
    rows = [(i, f"a{i} b{i} " + (line + "\n") * (20 + i % 7) + f"c{i}") for i in range(120)]
    cut = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = sorted((r.doc_id, r.n_words, r.n_removed, b" ".join(r.text.encode().split())) for r in cut.collect())
    assert got == sorted(brute_cut(rows))
    assert max(rows_out(cut._jdf.queryExecution().executedPlan(), "MapInArrow")) < 20 * len(rows)


# --- 9 token counts ---------------------------------------------------------

def test_counts_by_units_in_small_chunks(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK", 48)
    monkeypatch.setattr(token_counts, "OVERLAP", 16)
    rng = random.Random(17)
    parts = ["the", " the", "thing", "ß", "été", "12", " 3.5", "...", "\n", "  ", "\t", "\u2003", "\x1d", "'s", "'", "😀", "漢字", "<|endoftext|>", "x" * 90, "-" * 70,
             "Å", "Ωmega", "a1b2", "\xa0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(120))) for _ in range(400)]
    want = [len(library.encode(t, add_special_tokens=False)) for t in texts]
    assert sum(len(t) > 64 for t in texts) > 200
    assert token_counts.count_texts(texts, PATH) == want


def test_spliced_counts(library):
    encode = lambda s: library.encode(s, add_special_tokens=False)
    rng = random.Random(4)
    for t in odd_texts(400) + ["x" * 500, "ab " * 200, "中文" * 150, "1" * 300 + " a" * 100]:
        t *= rng.randint(1, 6)
        for chunk, overlap in ((20, 16), (50, 20), (64, 32)):
            assert token_counts.count_spliced(t, encode, chunk, overlap) == len(encode(t))


def test_token_counts(spark, library, docs):
    for r in queries.op9_token_counts(spark, SF001).collect():
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)
    long = "Some words, and more of them. " * 5000
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, long, 0), (3, "a", 0), (3, "a", 0)], "doc_id long, text string, n_tokens int")
    got = token_counts.with_token_counts(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted(
        [(0, len(library.encode(long, add_special_tokens=False))), (1, 0), (2, 0), (3, 1), (3, 1)])


def test_sentencepiece_counts():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["", "Hello there, world.", None, "a  b\n c" * 2000]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert token_counts.count_texts(texts, path) == [len(model.encode(t or "")) for t in texts]


# --- shapes that any text operator meets --------------------------------------

def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert packing.pack(packing.pieces_of(none, PATH)).count() == 0
    assert bpe.encode_decode(none, PATH).count() == 0
    assert quality.with_quality(none).count() == 0
    assert token_counts.with_token_counts(none, PATH).count() == 0


def test_null_ids_and_texts_in_packing_and_bpe(spark):
    df = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2), (2, "word " * 5000, 3)],
                               "doc_id long, text string, length int")
    rows = packing.pack(packing.pieces_of(df, PATH, 64, with_ids=True), 64).collect()
    assert sum(r.length for r in rows) == 3 + 5002      # a trailing space is one token more
    assert all(len(r.ids) == r.length for r in rows)
    got = bpe.encode_decode(df, PATH).collect()
    assert sorted((r.doc_id or 0, len(r.ids), len(r.decoded)) for r in got) == [(0, 0, 0), (1, 0, 0), (1, 0, 0), (2, 5001, 25000)]
