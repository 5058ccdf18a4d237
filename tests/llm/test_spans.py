import random

import pytest

from framewright.llm import spans

SPAN, GRAM = 30, 20


@pytest.fixture(scope="module")
def docs():
    random.seed(11)
    letters = "abcdefgh éЖ日"
    text = lambda n: "".join(random.choice(letters) for _ in range(n))
    shared = [text(n) for n in (29, 30, 31, 45, 80)]
    out = []
    for d in range(80):
        t = text(random.randrange(0, 150))
        for s in random.sample(shared, random.choice([0, 0, 1, 2])):
            at = random.randrange(len(t) + 1)
            t = t[:at] + s + t[at:]
        out.append((d, t))
    out += [(100, out[3][1]), (101, None), (102, ""), (103, "ab" * 400), (104, "x" + "ab" * 300), (105, "a" * 700), (106, "a" * 31), (107, out[5][1] + text(4)), (108, out[40][1]), (109, out[40][1])]
    return out


def brute(docs):
    at = {}
    for d, t in docs:
        for i in range(len(t or "") - SPAN + 1):
            at.setdefault(t[i : i + SPAN], []).append((d, i))
    pairs, cover = set(), {}
    for places in at.values():
        ids = sorted({d for d, _ in places})
        pairs |= {(a, b) for a in ids for b in ids if a < b}
        if len(ids) > 1:
            for d, i in places:
                cover.setdefault(d, set()).update(range(i, i + SPAN))
    return sorted(pairs), {d: len(c) for d, c in cover.items()}


@pytest.mark.parametrize("how", [{}, {"compared": 1}, {"compared": 3, "shard": 100}])
def test_against_brute_force(spark, docs, how):
    df = spark.createDataFrame([(*r, 1, "z") for r in docs], "doc_id long, text string, cid int, h string")
    pairs, cover = brute(docs)
    got = sorted(tuple(r) for r in spans.shared_pairs(df, "doc_id", "text", span=SPAN, gram=GRAM, **how).collect())
    assert got == pairs and len(pairs) > 50
    chars = {r.doc_id: r.shared_chars for r in spans.shared_chars(df, "doc_id", "text", span=SPAN, gram=GRAM, **how).collect()}
    assert chars == cover


def test_hot_groups_are_dealt_out(spark, monkeypatch):
    random.seed(4)
    text = lambda n: "".join(random.choice("abcdefgh") for _ in range(n))
    hot, copy = text(34), text(60)
    docs = [(i, text(10) + hot + text(i % 17)) for i in range(40)] + [(100 + i, copy) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    pairs, _ = brute(docs)
    for paired in (3, 1000):
        monkeypatch.setattr(spans, "PAIRED", paired)
        got = sorted(tuple(r) for r in spans.shared_pairs(df, "doc_id", "text", span=SPAN, gram=GRAM, compared=5).collect())
        assert got == pairs and len(pairs) == 40 * 39 // 2 + 30 * 29 // 2


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spans.shared_pairs(df, "doc_id", "text").collect() == []
    assert spans.shared_chars(df, "doc_id", "text").collect() == []


def test_text_keys_null_keys_and_repeated_rows(spark, docs):
    some = docs[:40] + docs[80:]
    named = [(f"d{d:03d}", t) for d, t in some]
    df = spark.createDataFrame([*named, (None, some[3][1]), (None, None)], "doc_id string, text string")
    pairs, cover = brute(named)
    assert sorted(tuple(r) for r in spans.shared_pairs(df, "doc_id", "text", span=SPAN, gram=GRAM).collect()) == pairs
    assert {r.doc_id: r.shared_chars for r in spans.shared_chars(df, "doc_id", "text", span=SPAN, gram=GRAM).collect()} == cover
    twice = spark.createDataFrame([*named, *named], "doc_id string, text string")
    got = {tuple(r) for r in spans.shared_pairs(twice, "doc_id", "text", span=SPAN, gram=GRAM).collect()}
    assert got == set(pairs)
