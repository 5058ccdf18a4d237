import random

import pyarrow.parquet as pq

from framewright.operators import smallfiles

HEAD = "Brand\tLocation\tDuration\tSequence Frame Number"


def pieces(spark, contents):
    rows = [(i, v, c, "z") for i, (v, c) in enumerate(contents)]
    return spark.createDataFrame(rows, "shard_id long, video string, content string, brand string")


def test_each_record_once(spark, rows):
    random.seed(2)
    records = [(random.choice("vw"), random.choice("AB"), "L", random.randrange(1, 5), random.randrange(100)) for _ in range(300)]
    contents = []
    for _ in range(60):
        some = [r for r in random.sample(records, 20)]
        v = some[0][0]
        lines = [f"{b}\t{loc}\t{d}\t{random.choice(['', 'v_000'])}{f}" for vv, b, loc, d, f in some if vv == v]
        contents.append((v, random.choice([HEAD + "\r\n", ""]) + random.choice(["\n", "\r\n"]).join(lines) + random.choice(["", "\n\n"])))
    contents += [contents[0], ("v", ""), ("v", None), ("v", HEAD), ("v", "broken\tline"), (None, "A\tL\t1\t5"), ("v", "A\tL\tx\tnone")]
    want = {(v, *r[:3]) for v, c in contents for r in smallfiles.parse_piece(c)}
    want = {(v, None if f < 0 else f, b, loc) for v, f, b, loc in want}
    for width in (16, 1 << 14):
        got = rows(smallfiles.consolidate(pieces(spark, contents), width=width).select("video", "frame_no", "brand", "location"))
        assert len(got) == len(set(got)) and set(got) == want


def written(path):
    return sorted(p for p in path.glob("file=*/*.parquet"))


def test_files(spark, tmp_path, rows):
    contents = [("v", "\n".join(f"Brand\tPlace\t1\t{i}" for i in range(s, s + 300))) for s in range(0, 900, 200)]
    made = smallfiles.write_consolidated(pieces(spark, contents), str(tmp_path), target=4000).collect()
    assert sum(r.records for r in made) == 1100 and len(made) == len(written(tmp_path)) > 3
    frames = [f for r in sorted(made, key=lambda r: r.path) for f in pq.ParquetFile(r.path.removeprefix("file:")).read()["frame_no"].to_pylist()]
    assert frames == list(range(1100))
    again = smallfiles.write_consolidated(pieces(spark, contents), str(tmp_path), target=4000).collect()
    assert len(again) == len(made) == len(written(tmp_path)) and sum(r.records for r in again) == 1100
    fewer = smallfiles.write_consolidated(pieces(spark, contents[:1]), str(tmp_path), target=1 << 20).collect()
    assert len(fewer) == len(written(tmp_path)) == 1 and smallfiles.read_consolidated(spark, str(tmp_path)).count() == 300
    meta = smallfiles.output_files(smallfiles.consolidate(pieces(spark, contents), target=4000))
    assert rows(meta.select("first_frame", "last_frame", "records")) == sorted(((r.first_frame, r.last_frame, r.records) for r in made), key=lambda r: tuple((False, str(v)) for v in r))


def test_files_span_videos(spark, tmp_path, rows):
    contents = [(v, "\n".join(f"Brand\tPlace\t1\t{i}" for i in range(s, s + 20))) for v in [None, *(f"v{i:03d}" for i in range(60))] for s in (0, 20, 1 << 14)]
    contents += [("v030", "\n".join(f"Brand\tPlace\t1\t{i}" for i in range(20_000, 20_400))), ("v031", "A\tL\t1\tnone")]
    want = sorted({(v or "", -1 if r[0] < 0 else r[0], r[1], r[2]) for v, c in contents for r in smallfiles.parse_piece(c)})
    target = 8000
    made = sorted(smallfiles.write_consolidated(pieces(spark, contents), str(tmp_path), target=target).collect(), key=lambda r: r.path)
    sizes = sum(16 + len((b + loc).encode()) for _, _, b, loc in want)
    assert len(made) == len(written(tmp_path)) <= sizes // target + 4 < 60
    files = [[(r["video"] or "", -1 if r["frame_no"] is None else r["frame_no"], r["brand"], r["location"]) for r in pq.ParquetFile(m.path.removeprefix("file:")).read().to_pylist()] for m in made]
    assert [r for f in files for r in f] == want
    assert [(f[0][0], f[-1][0], len(f)) for f in files] == [(m.first_video or "", m.last_video or "", m.records) for m in made]
    meta = smallfiles.packed_files(smallfiles.pack_ranges(smallfiles.consolidate(pieces(spark, contents), target=target), target))
    cols = ["first_video", "last_video", "first_frame", "last_frame", "records"]
    assert rows(meta.select(*cols)) == sorted((tuple(m[c] for c in cols) for m in made), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert max(r.n_bytes for r in meta.collect()) < 2 * target


def test_videos_that_look_alike(spark, tmp_path):
    videos = ["a b", "a_b", "a/b", "a.b", "éé", "üü", None, "None", ""]
    contents = [(v, "\n".join(f"B{i}\tPlace\t1\t{f}" for f in range(5))) for i, v in enumerate(videos)]
    for target in (1, 100, 1 << 20):
        made = smallfiles.write_consolidated(pieces(spark, contents), str(tmp_path / str(target)), target=target).collect()
        assert sum(r.records for r in made) == 45 and len(made) == len(written(tmp_path / str(target)))
        got = {(r.video, r.brand, r.frame_no) for r in smallfiles.read_consolidated(spark, str(tmp_path / str(target))).collect()}
        assert got == {(v, f"B{i}", f) for i, v in enumerate(videos) for f in range(5)}
    none = smallfiles.write_consolidated(pieces(spark, [("v", None), ("v", "")]), str(tmp_path / "none"))
    assert none.collect() == [] and smallfiles.read_consolidated(spark, str(tmp_path / "none")).collect() == []


def test_runs_are_opened_when_the_merge_reaches_them():
    held, most = set(), [0]

    def run(k, a):
        held.add(k)
        most[0] = max(most[0], len(held))
        for f in range(a, a + 10):
            yield f, "b", "l", 1
        held.discard(k)

    got = list(smallfiles.merge_runs(run(k, 8 * k) for k in range(200)))
    assert [r[0] for r in got] == list(range(8 * 199 + 10)) and most[0] <= 3
    assert list(smallfiles.merge_runs([])) == []


def test_runs():
    recs = smallfiles.parse_piece("B\tL\t1\t3\nB\tL\t1\t4\nA\tL\t1\t1")
    assert [len(r) for r in smallfiles.sorted_runs(recs)] == [2, 1]
    assert list(smallfiles.merge_runs([[(1, "a", "l", 1)], [(1, "a", "l", 3)]])) == [(1, "a", "l", 3)]
