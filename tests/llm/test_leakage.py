import random

import numpy as np
import pytest

from framewright.llm import leakage
from framewright.llm.hashing import gram_hashes, window_minima

VOCAB = [f"w{i}" for i in range(40)]


def brute(docs, items, n):
    def grams(t):
        w = leakage.words_of(t)
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    return sorted((d, i) for d, t in docs for i, x in items if grams(t) & grams(x))


@pytest.fixture(scope="module")
def corpus():
    random.seed(7)
    text = lambda n: [random.choice(VOCAB) for _ in range(n)]
    items = [(i, " ".join(text(random.randrange(5, 30)))) for i in range(30)]
    docs = []
    for d in range(200):
        w = text(random.randrange(0, 80))
        if random.random() < 0.5:
            x = random.choice(items)[1].split()
            k = random.choice([10, 11, 12, 13, 20])
            s = random.randrange(max(1, len(x) - k + 1))
            at = random.randrange(len(w) + 1)
            w[at:at] = x[s : s + k]
        docs.append((d, random.choice([" ", ", ", "-"]).join(x.upper() if random.random() < 0.3 else x for x in w)))
    return [*docs, (900, None), (901, ""), (902, "w1 " * 20000), (903, docs[0][1])], [*items, (50, None), (51, ""), (52, "w1 " * 12)]


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_against_brute_force(spark, corpus, sent):
    docs, items = corpus
    d = spark.createDataFrame([(*r, "z") for r in docs], "doc_id long, text string, item_id string")
    i = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, doc_id string")
    got = sorted(tuple(r) for r in leakage.leaked(d, i, "doc_id", "item_id", sent_chars=sent).collect())
    assert got == brute(docs, items, 12) and len(got) > 20


def test_repeated_and_null_keys_either_way(spark, corpus):
    docs, items = corpus
    d = [(None if k % 7 == 0 else k // 3, t) for k, t in docs] + [(1, docs[3][1]), (1, docs[3][1]), (None, docs[3][1])]
    i = [(None if k % 5 == 0 else k // 2, t) for k, t in items] + [(1, items[4][1]), (1, items[4][1]), (None, items[4][1])]

    def grams(t):
        w = leakage.words_of(t)
        return {tuple(w[j : j + 12]) for j in range(len(w) - 11)}

    sides = [(k, grams(t)) for k, t in d], [(k, grams(t)) for k, t in i]
    want = sorted(((a, b) for a, x in sides[0] for b, y in sides[1] if x & y), key=str)
    df, di = spark.createDataFrame(d, "doc_id long, text string"), spark.createDataFrame(i, "item_id long, text string")
    for sent in (1 << 20, 0):
        assert sorted((tuple(r) for r in leakage.leaked(df, di, "doc_id", "item_id", sent_chars=sent).collect()), key=str) == want
    assert len(want) > len(set(want)) and any(a is None for a, _ in want) and any(b is None for _, b in want)


def test_empty_sides(spark, corpus):
    docs, items = corpus
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert leakage.leaked(d.limit(0), i, "doc_id", "item_id").collect() == []
    assert leakage.leaked(d, i.limit(0), "doc_id", "item_id").collect() == []


def test_words():
    assert leakage.words_of("STRAẞE ﬁne_Ⅳ ２Σας") == ["strasse", "fine", "iv", "2σασ"]


def test_hashes():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n, w = int(rng.integers(1, 80)), int(rng.integers(1, 30))
        h = rng.integers(0, 6, n).astype(np.uint64)
        want = {s + max(i for i in range(w) if h[s + i] == h[s : s + w].min()) for s in range(n - w + 1)}
        assert window_minima(h, w).tolist() == sorted(want)
    x = rng.integers(0, 3, 300)
    for k in (1, 2, 5, 8, 100):
        seen = {}
        for i, h in enumerate(gram_hashes(x, k).tolist()):
            assert seen.setdefault(tuple(x[i : i + k]), h) == h
        assert len(set(seen.values())) == len(seen)
