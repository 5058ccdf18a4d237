import random

import pytest

from framewright.llm import encoding

NAMES = ["Øresprøit", "Żubrałek", "Gonbrirtrú", "Køkken Tårn Væg", "Çatı Gölgeliği", "Щит Северный", "Кронвестник", "Πίνακας Κερκίδας", "Año Cero Pórtico", "Łuk Startowy Żółty", "MAÇÃ VELUDA", "Café Terrasse Façade", "Warmup Hoarding", "Tunnel Headgear"]
BROKEN = ["utf_8>cp1252", "utf_8>latin_1", "utf_8>cp437", "utf_8>mac_roman", "utf_8>cp1252>utf_8>cp1252", "cp1252>cp1251", "cp1252>cp437"]


def test_undo_takes_back_damage():
    for name in NAMES:
        for chain in encoding.CHAINS:
            got = encoding.damage(name, chain)
            if got is not None and got != name and chain.startswith("utf_8"):
                assert encoding.undo(got, chain) == name, (name, chain, got)
    assert encoding.undo("TribÃ¼ne Süd", "utf_8>cp1252") == "Tribüne Süd"
    assert encoding.undo("Roboudre", "utf_8>cp1252") is None


@pytest.fixture(scope="module")
def table():
    random.seed(5)
    rows, want = [], {}
    for i in range(3000):
        name = random.choice(NAMES)
        value = random.choice([name] * 12 + [name.lower(), name.upper(), f"{name} "])
        if random.random() < 0.05 and not name.isascii():
            chain = random.choice(BROKEN)
            got = encoding.damage(name, chain)
            if got is not None and got != name:
                value, want[i] = got, name
        rows.append((i, random.choice(["one", "two", None]), value, None, "x"))
    rows += [(9000, "one", "K�kken T�rn V�g", "", "x"), (9001, "one", None, " ", "x"), (9002, "two", "x" * 50_000, "plain", "x"), (9003, "one", rows[0][2], None, "x")]
    want[9000] = "Køkken Tårn Væg"
    if 0 in want:
        want[9003] = want[0]
    return rows, want


def test_finds_and_restores(spark, table):
    rows, want = table
    df = spark.createDataFrame(rows, "row_id long, channel string, brand string, location string, value string")
    got = {r.row_id: r for r in encoding.damaged_fields(df, "row_id", "channel", ["brand", "location"]).collect()}
    assert len(want) > 60
    assert set(got) == set(want)
    right = sum(encoding.level(got[k].restored or "") == encoding.level(v) for k, v in want.items())
    assert right >= 0.97 * len(want)
    assert sum(got[k].restored == v for k, v in want.items()) >= 0.9 * len(want)


def test_the_same_at_every_size(spark):
    clean = ["Café Terrasse", "Warmup Hoarding", "Tribüne Süd", "Año Cero", "Gonbrirtrú"]
    rows = [(c, v) for c in ("one", "two") for v in clean for _ in range(9)]
    rows += [("one", encoding.damage(v, chain)) for v in clean if not v.isascii() for chain in ("utf_8>cp1252", "cp1252>cp437")]
    # As often as its clean form, and more often: what only one kind of slip gives is still found.
    rows += [("two", encoding.damage("Año Cero", "utf_8>cp1252"))] * 20
    found = []
    for times in (1, 40):
        data = [(i, c, v, None) for i, (c, v) in enumerate(rows * times)]
        df = spark.createDataFrame(data, "row_id long, channel string, brand string, location string")
        out = encoding.damaged_fields(df, "row_id", "channel", ["brand", "location"]).collect()
        assert len(out) % times == 0
        found.append({(r.value, r.restored) for r in out} | {len(out) // times})
    assert found[0] == found[1] and len(found[0]) > 8


def test_empty(spark, table):
    df = spark.createDataFrame(table[0], "row_id long, channel string, brand string, location string, value string").limit(0)
    assert encoding.damaged_fields(df, "row_id", "channel", ["brand", "location"]).collect() == []
