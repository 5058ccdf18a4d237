import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from framewright.llm import canonical

NAMES = [(1, "Stoñylim Software"), (2, "Roboudre"), (3, "Skymjaryr & Wyndraer"), (4, "Finish Gantry Carpet"), (5, "Warmup Backcloth"), (6, "Warmup Banner"), (7, "Køkken Tårn Væg"), (8, "Щит Северный"), (9, "Kaffeeßtern")]


MEANT = [("STONYLIM SOFTWARE", 1), ("Software, Stoñylim", 1), ("Stoñylim Soft.", 1), ("Stoñylm Softwaer", 1), ("Robuodre", 2), ("Skymjaryr and Wyn.", 3), ("FinishGantryCarpet", 4), ("Carpet Gantry Finish", 4), ("Warmup Bac", 5), ("Warmup Ban.", 6), ("Køkken Trn Vg", 7), ("kokken tarn vaeg", 7), ("Щит Сев.", 8), ("KAFFEESSTERN", 9), ("Roboudre Ltd", None), ("ask annotator", None), ("xx", None), ("???", None), ("Mufilaek Software", None), ("Warmup", None), ("", None)]
#: With how many words at the end are put behind the name.
BEHIND = [("Roboudre Ltd", 1, 2), ("Robuodre (TM)", 1, 2), ("Roboudre - new", 1, 2), ("kokken tarn vaeg no. 3", 2, 7), ("Finish_Gantry_Carpet #1", 1, 4), ("Roboudre S.A.", 1, 2), ("Mufilaek Software", 1, None), ("Ltd", 1, None)]


@pytest.mark.parametrize(("typed", "ref"), MEANT)
def test_meant(typed, ref):
    assert canonical.Entries(NAMES).meant(typed) == ref


@pytest.mark.parametrize(("typed", "words", "ref"), BEHIND)
def test_meant_without_what_stands_behind(typed, words, ref):
    assert canonical.Entries(NAMES).meant(typed, [words]) == ref
    assert canonical.Entries(NAMES).meant(typed, [words, 3, 9]) == ref


def test_what_stands_behind_is_learned(spark):
    ref = spark.createDataFrame([(i, "brand", f"Name{chr(97 + i)} Tools") for i in range(4)] + [(9, "brand", "Namea Tools Ltd")], "ref_id long, kind string, name string")
    typed = [f"name{c} tools ltd" for c in "abc"] + [f"Name{c}-Tools No. {i}" for i, c in enumerate("abcd")] + ["Nameb Tools Club", "Namec Tools Club", "named tools ltd", "Other Ltd", "ltd", None]
    values = spark.createDataFrame([("brand", v) for v in typed], "kind string, value string").filter("value is not null")
    got = {r.value: sorted(r.left_out or []) for r in canonical.with_tails(values, ref, least=2).collect()}
    assert got["nameb tools ltd"] == got["named tools ltd"] == got["Other Ltd"] == [1] and got["ltd"] == []
    assert got["Named-Tools No. 3"] == [2] and got["Nameb Tools Club"] == [1]
    got = {r.value: sorted(r.left_out or []) for r in canonical.with_tails(values, ref, least=3).collect()}
    assert got["Nameb Tools Club"] == [] and got["Namea-Tools No. 0"] == [2]


@pytest.mark.parametrize("size", [1_000, 100_000])
def test_recall_on_typings(size):
    random.seed(size)
    part = lambda: "".join(random.choice("aeioubcdfghklmnprstvz") for _ in range(random.randrange(4, 9)))
    names = [(i, f"{part()} {part()}") for i in range(size)]
    e = canonical.Entries(names)
    right = 0
    asked = random.sample(names, 100)
    for ref, name in asked:
        t = list(name)
        for _ in range(random.choice([1, 2])):
            i = random.randrange(len(t))
            t[i : i + 1] = random.choice([[], [random.choice("aeiou")], [t[i], "e"]])
        typed = "".join(t).upper()
        got = e.meant(typed)
        # brute force: the fewest mistyped letters over the whole list
        want = canonical.mistyped(canonical.plain(typed), canonical.plain(name), 9)
        right += got == ref or (got is not None and canonical.mistyped(canonical.plain(typed), canonical.plain(names[got][1]), 9) <= want)
    assert right >= 90


def test_every_similar_name_is_a_candidate():
    random.seed(3)
    names = [(i, "".join(random.choice("abcdef") for _ in range(random.randrange(3, 14)))) for i in range(200)]
    e = canonical.Entries(names)
    for _ in range(300):
        t = canonical.tokens_of("".join(random.choice("abcdef") for _ in range(random.randrange(1, 14))))
        want = {n for n, (*_, o) in enumerate(e.names) if len(t & o) / len(t | o) >= e.like}
        assert {n for n, _ in e.candidates(t)} == want


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_distance(a, b):
    def full(a, b):
        d = [[max(i, j) if 0 in (i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    for most in (0, 1, 2):
        assert canonical.mistyped(a, b, most) == min(full(a, b), most + 1)


def test_frame(spark):
    ref = spark.createDataFrame([(1, "brand", "Acme Tools", "Zed|Old Acme"), (2, "location", "Acme Tools", None), (3, "brand", "Bolt", None)], "ref_id long, kind string, name string, alt_names string")
    rows = [(1, "acme tools", "ACME TOOLS", "x"), (2, "Acme Tools", None, "x"), (3, " ", " ", "x"), (4, "Old Acme", "nobody", "x"), (5, "zed", "y" * 100_000, "x"), (6, "acme tools", "", "x")]
    df = spark.createDataFrame(rows, "row_id long, brand string, location string, value string")
    got = sorted((r.row_id, r.field, r.ref_id) for r in canonical.map_fields(df, "row_id", ["brand", "location"], ref).collect())
    assert got == [(1, "brand", 1), (1, "location", 2), (4, "brand", 1), (4, "location", -1), (5, "brand", 1), (5, "location", -1), (6, "brand", 1)]
    assert canonical.map_fields(df.limit(0), "row_id", ["brand", "location"], ref).collect() == []
    joined = sorted((r.row_id, r.field, r.ref_id) for r in canonical.map_fields(df, "row_id", ["brand", "location"], ref, sent_chars=3).collect())
    assert joined == got


def test_joined_list_agrees(spark):
    random.seed(8)
    words = ["".join(random.choice("abcdeo") for _ in range(random.randrange(3, 9))) for _ in range(60)]
    names = [(i, "brand", " ".join(random.sample(words, random.choice([1, 2]))).title(), None) for i in range(80)]
    ref = spark.createDataFrame(names, "ref_id long, kind string, name string, alt_names string")
    typed = []
    for _ in range(300):
        t = list(random.choice(names)[2])
        for _ in range(random.choice([0, 1, 2, 3])):
            t[random.randrange(len(t))] = random.choice("abcdeo ")
        typed.append(("brand", random.choice(["", " "]) + "".join(t) + random.choice(["", "", " Ltd", " 2"])))
    df = spark.createDataFrame(typed, "kind string, value string")
    sent = sorted(tuple(r) for r in canonical.map_values(df, ref).collect())
    assert sorted(tuple(r) for r in canonical.map_values(df, ref, sent_chars=0).collect()) == sent
    assert len({r[2] for r in sent}) > 40
