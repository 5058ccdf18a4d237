import random
import re
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from framewright.functions import names, numbers, text, times
from framewright.operators import fuzzy, images, ontology, vectors


def one(spark, value, *exprs):
    df = spark.createDataFrame([(value,)], "x string")
    return tuple(df.select(*[e(F.col("x")).alias(f"c{i}") for i, e in enumerate(exprs)]).first())


def test_text(spark):
    assert one(spark, " \t a b 　", text.strip_all) == ("a b",)
    assert one(spark, "x12_0034.jpg", text.last_number, text.first_number) == (34, 12)
    assert one(spark, "none", text.last_number) == (None,)
    assert one(spark, "9" * 30, text.last_number) == (None,)


def test_times(spark):
    assert one(spark, "01:02:03", times.seconds_of) == (3723,)
    assert one(spark, "1:2", times.seconds_of) == (None,)
    assert one(spark, "2359", lambda c: times.screen_time(c, F.lit(120))) == ("00:01:00",)
    assert one(spark, "1275", times.start_time) == ("0000",)
    assert str(one(spark, "31/12/2020", times.day)[0]) == "2020-12-31"
    assert one(spark, "12252020", times.guessed_day) == ("25/12/2020",)
    assert one(spark, "x", lambda c: times.clock(F.lit(90000)), lambda c: times.spoken(F.lit(75))) == ("25:00:00", "1 min 15 sec")


def test_numbers(spark):
    df = spark.createDataFrame([(0.0,), (0.25,), (float("nan"),), (float("inf"),)], "x double")
    assert [r[0] for r in df.select(numbers.finite_or_zero(F.col("x"))).collect()] == [0.0, 0.25, 0.0, 0.0]
    assert df.select(numbers.log_measure(F.col("x"))).first()[0] == 23.026
    box = spark.sql("SELECT 10.0 x0, 20.0 y0, 110.0 x1, 70.0 y1").select(numbers.box_percent(*[F.col(c) for c in ("x0", "y0", "x1", "y1")], F.lit(1000.0), F.lit(500.0))).first()[0]
    assert box == 1.0
    zones = [(1, 1, "B"), (1, 99, "E"), (30, 1, "B"), (30, 50, "A"), (30, 80, "E"), (60, 1, "C"), (60, 50, "A"), (60, 80, "D"), (80, 1, "C"), (80, 60, "D")]
    df = spark.createDataFrame(zones, "x int, y int, z string")
    assert all(r[0] == r.z for r in df.select(numbers.zone(F.col("x"), F.col("y"), F.lit(100), F.lit(100)), "z").collect())
    v = spark.sql("SELECT array(1.0D, 2.0D, 3.0D) a, array(2.0D, 4.0D, 6.5D) b, array(1.0D, 1.0D, 1.0D) c")
    r = v.select(numbers.cosine(F.col("a"), F.col("b")), numbers.pearson(F.col("a"), F.col("b")), numbers.pearson(F.col("a"), F.col("c"))).first()
    assert abs(r[0] - 29.5 / (14**0.5 * 62.25**0.5)) < 1e-9 and abs(r[1] - np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1]) < 1e-9 and r[2] is None


def test_names(spark):
    assert one(spark, "reduced_game_part 2-x.tsv", names.base_name) == ("game",)
    assert one(spark, "a1-2-final", names.dashed_digits) == ("a1_2",)
    assert one(spark, "ManUtdGame", names.spaced_camel) == ("Man Utd Game",)
    assert one(spark, "a.tsv", lambda c: names.collision_safe(c, F.lit(1)), lambda c: names.collision_safe(c, F.lit(3))) == ("a.tsv", "a_2.tsv")
    df = spark.createDataFrame([("f10",), ("F9",), ("f1",)], "n string")
    assert [r.n for r in df.orderBy(names.natural_key(F.col("n"))).collect()] == ["f1", "F9", "f10"]


def test_fuzzy(spark, rows):
    df = spark.createDataFrame([("Acme Tools",), ("tools, ACME",), ("Acme",), ("Bolt",), (None,), ("Acme Tools",)], "b string")
    assert rows(fuzzy.contained_pairs(df, "b")) == [("Acme", "Acme Tools"), ("Acme", "tools, ACME"), ("Acme Tools", "tools, ACME")]
    near = spark.createDataFrame([("Roboudre",), ("Robouder",), ("Roboudrex",), ("Zed",)], "b string")
    got = fuzzy.likely_misspellings(near, "b", 20.0).collect()
    assert {r.label for r in got} <= {"Roboudre", "Robouder", "Roboudrex"} and got
    assert fuzzy.contained_pairs(df.limit(0), "b").collect() == []


def test_misspellings_against_brute_force(spark):
    one = spark.createDataFrame([("Roboudre",), ("Roboudrex",), ("Quagmyll",), ("ab",), ("abx",)], "b string")
    assert {(r.label, r.second) for r in fuzzy.likely_misspellings(one, "b", 10.0).collect()} == {("Roboudre", "Roboudrex"), ("Roboudrex", "Roboudre")}
    rng = random.Random(5)
    made = {"".join(rng.choice("abcé ") for _ in range(rng.randrange(1, 25))) for _ in range(60)}
    for x in sorted(made):
        for _ in range(3):
            i = rng.randrange(len(x))
            made.add(x[:i] + rng.choice(["", "z", "q7", "b_"]) + x[i + rng.randrange(2) :])
    df = spark.createDataFrame([(x,) for x in sorted(made)] + [(None,), ("",), ("12",)], "b string")
    labels = sorted({re.sub(" {2,}", " ", re.sub("[0-9_]+", "", x)).strip(" ") for x in made} - {""})
    for apart in (10.0, 30.0):
        want = set()
        for x in labels:
            score, y = min((-round(SequenceMatcher(None, y, x, autojunk=False).ratio() * 100, 3), y) for y in labels if y != x)
            if 0 < 100 + score < apart:
                want.add((x, y, -score))
        for block in (16, 2048):
            assert {(r.label, r.second, r.second_score) for r in fuzzy.likely_misspellings(df, "b", apart, block).collect()} == want and want


RULES = "Spartans\n\tTunnel <= tunnel^side|tunnel\n\tGate <= gat.s\n\t$$$ game <= match\n\t*** x <= no^tunnel\nHosts\n\tNever <= side"


def test_ontology(spark, rows):
    rules = ontology.parse_rules(RULES)
    assert {(r.kind, r.alternative) for r in rules} >= {("keyword", "tunnel side"), ("secondary", "match"), ("unwanted", "no tunnel")}
    assert ontology.mentions(rules, "The match: TUNNEL SIDE and gates", "u") == [("Spartans", "Tunnel", "tunnel side"), ("Spartans", "Gate", "gates")]
    assert ontology.mentions(rules, "no tunnel match", None) == []
    assert ontology.mentions(rules, "tunnel", "the_match") == [("Spartans", "Tunnel", "tunnel")]
    assert ontology.mentions(rules, None, None) == []
    df = spark.createDataFrame([(1, "match tunnel gates", None), (2, "gatos match", None), (3, None, "x")], "id long, t string, u string")
    found = [(r.id, r.text_id, r.official, r.keyword) for r in ontology.find_mentions(df, rules, "id", "t", "u").collect()]
    assert sorted(found) == [(1, 1, "Tunnel", "tunnel"), (1, 2, "Gate", "gates"), (2, 1, "Gate", "gatos")]
    assert [r.official for r in ontology.contains_rules(df, rules, "id", "t").collect()] == ["Tunnel"]
    lab = spark.createDataFrame([("Left Overlay",), ("x",), (None,)], "v string")
    assert [r[0] for r in lab.select(ontology.relabel(F.col("v"), [("left", "L"), ("overlay", "O")])).collect()] == ["O", "x", None]


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    x[10] = x[11]
    df = spark.createDataFrame([(i, [float(v) for v in r], "q") for i, r in enumerate(x)] + [(900, None, "q")], "id long, embedding array<double>, rank string")
    got = {}
    for r in vectors.nearest(df, df.filter("id % 20 = 0"), "id", 5, block=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id))
    for q in range(0, 300, 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        assert [i for _, i in sorted(got[q])] == np.lexsort((np.arange(300), d))[:5].tolist()


def test_pairs_within_clusters_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x, label = rng.normal(size=(200, 6)), rng.choice(["a", "b"], 200, p=[0.85, 0.15])
    x[7] = 0
    data = [(i * 7, str(c), [float(v) for v in r]) for i, (r, c) in enumerate(zip(x, label, strict=True))]
    df = spark.createDataFrame([*data, (9001, None, data[0][2]), (9002, None, data[0][2]), (9003, "a", None)], "id long, label string, embedding array<double>")
    u = x / np.where((n := np.sqrt((x**2).sum(1))) > 0, n, 1)[:, None]
    want = {(str(label[i]), i * 7, j * 7) for i in range(200) for j in range(i + 1, 200) if label[i] == label[j] and u[i] @ u[j] > 0.6}
    for block in (16, 1024):
        got = vectors.alike_in_clusters(df, "label", "id", 0.6, block=block).collect()
        assert len(got) == len(want) > 500 and {tuple(r)[:3] for r in got} == want
    assert vectors.alike_in_clusters(df.limit(0), "label", "id", 0.6).collect() == []


def test_centrality(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 4))
    df = spark.createDataFrame([(i, i % 3, [float(v) for v in r]) for i, r in enumerate(x)], "id long, c int, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    for r in vectors.centrality(df, "c").collect():
        same = [j for j in range(40) if j % 3 == r.c]
        assert abs(r.centrality - sum(u[r.id] @ u[j] for j in same)) < 1e-9


def test_pictures():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 256, (60, 90, 3)).astype(np.uint8)
    b = rng.integers(0, 256, (60, 90, 3)).astype(np.uint8)
    assert images.region_similarity(a, a) == 1.0 and images.region_similarity(a, b) < 0.9
    assert images.strict_similarity(a, a) == 1.0 and images.strict_similarity(a, b) < 0.9
    grey = a[:, :, 0]
    part = images.crop(grey, 20, 10, 15, 12)
    assert part.shape == (12, 15) and images.template_score(grey, part) > 0.999
    assert images.any_template(grey, [b[:12, :15, 0], part], 0.9) == 1 and images.any_template(grey, [b[:12, :15, 0]], 0.9) == -1
    assert images.decode({"height": -1, "width": 0, "nChannels": 0, "data": b""}) is None


def test_columns(spark, rows):
    from framewright.operators import columns, joins

    df = spark.createDataFrame([("f", 3, 1), ("f", 7, 2), ("f", None, 3)], "f string, v int, r int")
    assert columns.move_column(df, "r", 0).columns == ["r", "f", "v"] and columns.swap_columns(df, "f", "r").columns == ["r", "v", "f"]
    assert rows(columns.closest(df, ["f"], "v", F.lit(5), "r")) == [("f", 3)]
    assert [r.r for r in columns.preview(df, ["r"], -5, 2).collect()] == [1, 2]
    boxes = spark.sql("SELECT array(named_struct('b', 1, 't', 2), named_struct('b', 1, 't', 3)) x")
    assert tuple(boxes.select(columns.has_repeats(F.col("x"), ["b"]), columns.has_repeats(F.col("x"), ["b", "t"])).first()) == (True, False)
    assert one(spark, "a  b\tc", text.word_count) == (3,) and one(spark, "12 photos", text.word_count) == (12,) and one(spark, "__", text.word_count) == (None,)
    start, second = times.start_of_frame(F.col("x"))
    assert tuple(spark.createDataFrame([("WV_a_1830_77",)], "x string").select(start, second).first()) == ("1830", 77)
    ann = spark.createDataFrame([("g_0001", 1, 1), ("0007", 1, 1)], "frame string, d int, h int")
    by_prefix = spark.createDataFrame([("g_0001.jpg", 4)], "first_image string, n int")
    by_number = spark.createDataFrame([("7.jpg", 2)], "first_image string, n int")
    assert rows(joins.add_runs(ann, by_prefix, "frame", "first_image", "n", ["d", "h"])) == [("0007", 1, 1), ("g_0001", 5, 5)]
    assert rows(joins.add_runs(ann, by_number, "frame", "first_image", "n", ["d", "h"])) == [("0007", 3, 3), ("g_0001", 1, 1)]
