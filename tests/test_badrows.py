import re

from hypothesis import given, settings
from hypothesis import strategies as st

from framewright.operators import badrows

GOOD = ["Acme", "Board", "10:00:00", "3", "A", "1.5", "3", "1", "x_0001"]
HEAD = "Brand;Location;Time the brand is at screen;Duration;Screen Location;Screen Size %;Total Hits;Average Hits;Sequence Frame Number"


def frame(spark, lines, first=HEAD):
    rows = [(i + 1, "f", i + 1, x, "z") for i, x in enumerate([first, *lines])]
    return spark.createDataFrame(rows, "line_id long, file_name string, line_no int, raw string, brand string")


def line(**change):
    f = dict(zip(badrows.FIELD_PATTERNS, GOOD, strict=True)) | change
    return ";".join(f.values())


def test_reasons(spark):
    cases = [
        (line(), None),
        (line() + "\r", None),
        (line(brand='"A;B"'), None),
        (line(brand='"A ""x"" B"'), None),
        (line(brand='"A'), "quoting"),
        (line(brand='A"'), "quoting"),
        (line(brand='"A"x'), "quoting"),
        (line() + ";", "column_count"),
        ("", "column_count"),
        (None, "column_count"),
        ("   ", "column_count"),
        (line(brand=" "), "value"),
        (line(location=""), "value"),
        (line(screen_time="24:00:00"), "value"),
        (line(duration="0"), "value"),
        (line(duration="-2"), "value"),
        (line(screen_location="a"), "value"),
        (line(screen_size_pct="100.1"), "value"),
        (line(screen_size_pct="100"), None),
        (line(total_hits="3.0"), "value"),
        (line(average_hits="2,0"), "value"),
        (line(frame="12b"), "value"),
        (line(frame="a_b_7"), None),
        (line(brand="x" * 100_000), None),
        (line(brand='"' + '""' * 50_000 + '"'), None),
    ]
    df = frame(spark, [c for c, _ in cases])
    got = {r.line_id: r.reason for r in badrows.rejected_lines(df).collect()}
    assert got == {i + 2: r for i, (_, r) in enumerate(cases) if r}
    loaded = {r.line_id: r for r in badrows.strict_load(df).collect()}
    assert sorted(loaded) == [i + 2 for i, (_, r) in enumerate(cases) if not r]
    assert loaded[4].brand == "A;B" and loaded[5].brand == 'A "x" B' and loaded[2].duration == 3


def test_byte_order_mark_and_missing_header(spark):
    df = frame(spark, [line().replace(";", "\t")], first="﻿" + HEAD.replace(";", "\t") + "\r")
    assert badrows.rejected_lines(df).collect() == []
    late = df.filter("line_no > 1")
    assert badrows.rejected_lines(late).collect() == []
    assert badrows.rejected_lines(df.limit(0)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='ab;"', max_size=4), min_size=1, max_size=5))
def test_split_round_trip(fields):
    quoted = ";".join('"' + f.replace('"', '""') + '"' if re.search('[;"]', f) else f for f in fields)
    assert badrows.split_quoted(quoted, ";") == fields
