"""Personal data: patterns against a naive version, the model against brute force and planted data."""

import itertools
import random
import re

import numpy as np
import pytest

from abx.llm import pii, queries, tagger
from conftest import SF001

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def naive(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda m=m: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda d=d: 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0,
                    "phone": lambda d=d: 9 <= len(d) <= 15}[kind]()
            if good:
                spans.append((pii.KINDS.index(kind), *m.span()))
    return sorted(spans, key=lambda s: (s[1], s[0]))


def test_patterns_equal_naive_ones():
    rng = random.Random(1)
    parts = ["a", "Z", "7", "0", "255", "256", "12", "4111111111111111", ".", "..", "@", "-", " ", "+", "(", ")", "%", "_", "é", "\n", "４", "+1 (017) 555-7713",
             "x.y@a.b", "1.2.3.4", "@@"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text)[0] == naive(text), text


def test_patterns_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "@" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a@b" * 100_000, "- " * 150_000):
        pii.base_spans(text)


def small_tagger(seed=0, hidden=3, labels=5):
    rng = np.random.default_rng(seed)
    w = {"bias": rng.normal(size=labels), "start": rng.normal(size=labels), "move": rng.normal(size=(labels, labels))}
    for d in "fb":
        w |= {f"in_{d}": rng.normal(0, 0.5, (4 * hidden, tagger.CLASSES)), f"rec_{d}": rng.normal(0, 0.5, (4 * hidden, hidden)),
              f"out_{d}": rng.normal(size=(labels, hidden))}
    return tagger.Tagger(("a", "b"), tagger.Settings(hidden=hidden, window=24, overlap=8), w)


def test_gradient_by_differences():
    t, rng = small_tagger(), np.random.default_rng(1)
    codes = rng.integers(0, 130, (6, 4))
    gold = np.array([[0, 1, 0, 3], [0, 2, 0, 4], [1, 2, 1, 0], [2, 0, 2, 1], [0, 0, 0, 2], [3, 0, 1, 0]])
    _, g = tagger.gradient(t, codes, gold)
    for k, w in t.weights.items():
        for _ in range(8):
            at = tuple(rng.integers(0, n) for n in w.shape)
            if k.startswith("in"):
                at = (at[0], rng.choice(codes.ravel()))
            old = w[at]
            w[at] = old + 1e-5
            up = tagger.gradient(t, codes, gold)[0]
            w[at] = old - 1e-5
            down = tagger.gradient(t, codes, gold)[0]
            w[at] = old
            assert g[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-7)


def test_paths_equal_enumeration():
    t = small_tagger(3)
    start, move = tagger.allowed(5)
    t.weights["start"] += start
    t.weights["move"] += move
    rng = np.random.default_rng(2)
    lengths = np.array([6, 6, 4, 1])
    scores = rng.normal(0, 2, (6, 5, 4))
    scores[:, 0] += 2.0
    paths = tagger.best_paths(t, scores, lengths)
    suspect = set(tagger.suspects(t, scores).tolist())
    for i, n in enumerate(lengths):
        def worth(p, i=i):
            return (t.weights["start"][p[0]] + sum(scores[s, x, i] for s, x in enumerate(p))
                    + sum(t.weights["move"][a, b] for a, b in itertools.pairwise(p)))
        best = max(itertools.product(range(5), repeat=n), key=worth)
        assert tuple(paths[i]) == best
        assert i in suspect or not any(best)


def test_windows_left_out_hold_no_span():
    t = small_tagger(5)
    start, move = tagger.allowed(5)
    t.weights["start"] += start
    t.weights["move"] += move
    scores = np.random.default_rng(6).normal(0, 1, (12, 5, 400))
    scores[:, 0] += 5.0
    some = set(tagger.suspects(t, scores).tolist())
    assert 0 < len(some) < 400
    for i, path in enumerate(tagger.best_paths(t, scores, np.full(400, 12))):
        assert i in some or not path.any()


def test_windows_side_by_side_score_as_alone():
    t = small_tagger(7)
    t.weights = {k: v.astype(np.float32) for k, v in t.weights.items()}
    rng = np.random.default_rng(8)
    windows = [rng.integers(0, 129, n).astype(np.uint8) for n in (24, 24, 13, 13, 5, 1)]
    scores = tagger.label_scores(t, windows)
    w = t.weights
    for i, x in enumerate(windows):
        states = [np.array([s[0] for s in tagger._direction(w[f"in_{d}"], w[f"rec_{d}"], y.astype(int)[:, None])])
                  for d, y in (("f", x), ("b", x[::-1]))]
        alone = w["out_f"] @ states[0] + w["out_b"] @ states[1][::-1] + w["bias"][:, None]
        assert np.allclose(scores[:len(x), :, i], alone[:, :, 0], atol=1e-4)


def test_window_starts():
    for n in range(200):
        starts = tagger.window_starts(n, 24, 8)
        assert {x for a in starts for x in range(a, min(a + 24, n))} == set(range(n))
        assert all(b - a == 16 for a, b in itertools.pairwise(starts)) and all(a < max(n, 1) for a in starts)


def test_reconcile():
    same = (0, 10, 20, 5, False, False)
    assert tagger.reconcile([same, (0, 10, 20, 9, False, False)]) == [(0, 10, 20)]
    assert tagger.reconcile([(1, 10, 24, 0, False, True), (1, 16, 30, 8, False, False)]) == [(1, 10, 30)]     # cut by an edge
    assert tagger.reconcile([(1, 10, 20, 3, False, False), (1, 15, 30, 8, False, False)]) == [(1, 15, 30)]    # the deeper stays
    assert tagger.reconcile([(1, 10, 20, 8, False, False), (0, 15, 30, 8, False, False), (2, 30, 31, 0, False, False)]) == [(0, 15, 30), (2, 30, 31)]
    assert tagger.reconcile([]) == []


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.createDataFrame([(t,) for t in planted(1500, 1)], "text string").repartition(4)
    return pii.fit(docs, sampling=pii.Sampling(per_kind=300), settings=tagger.Settings(epochs=7))


def words(rng, n):
    return " ".join("".join(rng.choice(["en", "tha", "re", "ou", "la", "sch", "é", "in"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def datum(rng, kind):
    if kind == 0:
        return f"{words(rng, 1)}.{rng.randrange(100):02}@mail{rng.randrange(10)}.example.com".replace("é", "e")
    if kind == 1:
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        head = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(head + c for c in "0123456789" if pii.luhn(head + c))
    return f"+1 ({rng.randrange(1000):03}) 555-{rng.randrange(10000):04}"


def planted(n, seed):
    rng = random.Random(seed)
    return [f"{words(rng, rng.randrange(3, 30))} {datum(rng, i % 4) if i % 5 else rng.randrange(10 ** 5)} {words(rng, rng.randrange(3, 30))}"
            for i in range(n)]


def test_model_finds_labelled_spans_it_has_not_seen(trained):
    texts = planted(400, 99)
    total = hit = wrong = 0
    for found, text in zip(tagger.tag(trained, texts), texts, strict=True):
        base = set(pii.base_spans(text)[0])
        total, hit, wrong = total + len(base), hit + len(base & set(found)), wrong + len(set(found) - base)
    assert hit >= 0.95 * total and wrong <= 0.05 * total


def test_model_adds_what_the_patterns_give_up_on(trained):
    rng = random.Random(5)
    texts, want = [], []
    for k in range(60):
        a, b = [(datum(rng, 2), datum(rng, 2)), (datum(rng, 3), datum(rng, 1))][k % 2]
        before = words(rng, 12) + " "
        texts.append(f"{before}{a} {b} {words(rng, 12)}")
        want.append((2 if k % 2 == 0 else 3, len(before), len(before) + len(a)))
    found = pii.spans_of(texts, trained)
    assert sum(w in added for w, (_, added) in zip(want, found, strict=True)) >= 45
    for text, (base, added) in zip(texts, found, strict=True):
        assert base == naive(text)
        assert all(pii.holds_value(k, text[a:b]) for k, a, b in added)
        places = sorted((a, b) for _, a, b in added)
        assert all(y <= a for (_, y), (a, _) in itertools.pairwise(places))
        assert all(b <= x or a >= y for _, x, y in base for a, b in places)
    assert not any(added for _, added in pii.spans_of([words(rng, 300) for _ in range(30)], trained))


def test_windows_without_a_mark_add_nothing(trained):
    rng = random.Random(11)
    texts = [" ".join(rng.choice([words(rng, 60), words(rng, 200), datum(rng, rng.randrange(4)), datum(rng, 2) + " " + datum(rng, 2), "a (at) b.cc", "é(AT)x[.]yy"])
                      for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    assert pii.spans_of(texts, trained) == pii.spans_of(texts, trained, everywhere=True)
    for kind, s in itertools.product(range(4), ["", " ", "abc", "a.b", "(at", "a at b.c", "+", "()-"]):
        assert not pii.holds_value(kind, s) or len(pii.marks(s))


def test_spans_do_not_depend_on_windows(trained):
    rng = random.Random(6)
    one = [(datum(rng, 2), datum(rng, 2), words(rng, 10)) for _ in range(40)]
    text = " ".join(f"{c} {a} {b}" for a, b, c in one) + " " + words(rng, 40_000)
    base, added = pii.spans_of([text], trained)[0]
    assert len(text) > 150_000 and base == naive(text) and len(added) >= 60


def test_find_edges(spark, trained):
    cols = "doc_id long, text string, base string, id string, t string, added int"
    rows = [(1, None), (2, ""), (3, "x@y.zz 10.0.0.1"), (3, "x@y.zz 10.0.0.1"), (None, "+1 (017) 555-7713"), (5, "é\U0001f600 a@b.cc"), (6, " \n")]
    df = spark.createDataFrame([(*r, "b", "i", "t", 1) for r in rows], cols)
    for model in (trained, None):
        got = pii.find(df, model)
        assert got.columns == ["doc_id", "base", "added"]
        found = sorted(((r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.added]) for r in got.collect()), key=str)
        assert found == sorted([(1, [], []), (2, [], []), *[(3, [("email", 0, 6), ("ip", 7, 15)], [])] * 2, (None, [("phone", 0, 17)], []),
                                (5, [("email", 3, 9)], []), (6, [], [])], key=str)
    assert pii.find(df.where("false"), trained).count() == 0
    assert pii.fit(df.where("false")) is None and pii.fit(df.where("doc_id = 1")) is None
    joined = got.select("doc_id", pii.joined(pii.merged(got.base, got.added)).alias("s"), pii.count_of(got.base, "ip").alias("n")).where("doc_id = 3").first()
    assert joined.s == "email:0:6,ip:7:15" and joined.n == 1


def test_given_labels_are_learned(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(600):
        a, code, b = words(rng, 8) + " ", f"<{rng.choice('ABCDEF')}{rng.randrange(1000):03}>", " " + words(rng, 8)
        rows.append((a + code + b, [("card", len(a), len(a) + len(code))]))
    rows += [("x", None), (None, None), ("y", [("other", 0, 1)])]
    model = pii.fit(spark.createDataFrame(rows, f"text string, marks {pii.SPANS}"), spans_col="marks",
                    settings=tagger.Settings(epochs=12))
    text = words(rng, 8) + " <B123> " + words(rng, 8)
    assert tagger.tag(model, [text])[0] == [(2, text.index("<"), text.index(">") + 1)]


def test_registered_query_equals_one_process(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    model = pii.fit(docs, sampling=pii.Sampling(per_kind=60), settings=tagger.Settings(epochs=3))
    monkeypatch.setattr(pii, "fit", lambda d: model)
    got = {r.doc_id: r for r in queries.op13_pii(spark, SF001).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r, (base, added) in zip(rows, pii.spans_of([r.text or "" for r in rows], model), strict=True):
        g = got[r.doc_id]
        assert base == naive(r.text or "")
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(k == i for k, *_ in base) for i in range(4)]
        assert g.spans == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(base + added, key=lambda s: (s[1], s[0])))
        assert g.n_added == len(added)
