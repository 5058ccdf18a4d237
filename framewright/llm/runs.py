"""Runs of near-identical consecutive events.

Per entity the ordered events are segmented by dynamic programming: the best segmentation minimises the boundaries
first and then the letters in which the events differ from what their run means.  Only open segments that can still be
extended are kept, and of two with one meaning only the one that isn't worse in cost and coverage, so a step looks at a
few.

Entities are cut into stretches of ``CHUNK`` positions.  Between two events that can't mean the same a boundary is
certain, whatever stands before them, so a stretch falls into pieces that are segmented each by itself with the result
that the whole entity gives.  Only the events before a stretch's first certain boundary, and those behind its last one,
depend on its neighbours: they go on, joined over the stretches, and are segmented in a second step.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.labels import digits, meanings, plain
from framewright.session import store

#: Positions per stretch.
CHUNK = 1 << 14
#: What one boundary costs, in letters: more than any run of events can differ in.
BOUNDARY = 1 << 40

Meaning = tuple[str, ...]


class _Open:
    """A segment that may go on; ``prior`` is the best segmentation before it."""

    __slots__ = ("cost", "count", "end", "first", "means", "prior", "total")

    def __init__(self, means: Meaning, cost: int, first: int, end: int, count: int, total: int, prior: _Open | None):
        self.means, self.cost, self.first, self.end, self.prior = means, cost, first, end, prior
        self.count, self.total = count, total


class _Event:
    """One event, or several in a row that can mean one thing only and follow on each other."""

    __slots__ = ("count", "end", "first", "possible", "total")

    def __init__(self, first: int, end: int, count: int, total: int, possible: dict[Meaning, int]):
        self.first, self.end, self.count, self.total, self.possible = first, end, count, total, possible


class Segmenter:
    """Takes ordered events one by one; it holds the segments, not the events."""

    def __init__(self) -> None:
        self.open: list[_Open] = []

    def add(self, e: _Event) -> None:
        best = min(self.open, key=lambda s: s.cost) if self.open else None
        base = (best.cost if best else 0) + BOUNDARY
        step = [_Open(s.means, s.cost + e.possible[s.means], s.first, max(s.end, e.end), s.count + e.count, s.total + e.total, s.prior) for s in self.open if s.means in e.possible and e.first <= s.end + 1]
        step += [_Open(m, base + letters, e.first, e.end, e.count, e.total, best) for m, letters in e.possible.items()]
        if len(step) > 1:
            step.sort(key=lambda s: (s.cost, -s.end, s.first, s.means))
        kept: list[_Open] = []
        for s in step:
            if not any(o.means == s.means and o.end >= s.end for o in kept):
                kept.append(s)
        self.open = kept

    def segments(self) -> list[_Open]:
        out = []
        s = min(self.open, key=lambda s: s.cost) if self.open else None
        while s is not None:
            out.append(s)
            s = s.prior
        return out[::-1]


def _segmented(events: Iterable[_Event]) -> list[_Open]:
    s = Segmenter()
    for e in events:
        s.add(e)
    return s.segments()


def segment(events: list[tuple[int, int, dict[Meaning, int]]]) -> list[_Open]:
    """The best segmentation of ordered events (position, length, possible meanings with their letters).

    A segment's events share a meaning, and each starts no later than right after what the segment covers so far.  Of
    segmentations that cost the same the one that is found first stays: the order is by cost, then reach, then start,
    then meaning.
    """
    return _segmented(_Event(p, p + n - 1, 1, n, possible) for p, n, possible in events)


class Pieces:
    """One stretch's events, taken one by one and cut at the certain boundaries."""

    def __init__(self) -> None:
        self.events: list[_Event] = []
        self.cut = False

    def add(self, first: int, length: int, possible: dict[Meaning, int]) -> list[_Event] | None:
        """Returns the piece that ends before this event, if one does."""
        end, last = first + length - 1, self.events[-1] if self.events else None
        if last is not None and last.possible.keys().isdisjoint(possible):
            done, self.events = self.events, [_Event(first, end, 1, length, possible)]
            return done
        if last is not None and len(possible) == len(last.possible) == 1 and first <= last.end + 1:
            # No segmentation has a boundary here: going on costs less and reaches as far.
            (m, letters), *_ = possible.items()
            self.events[-1] = _Event(last.first, max(last.end, end), last.count + 1, last.total + length, {m: last.possible[m] + letters})
            return None
        self.events.append(_Event(first, end, 1, length, possible))
        return None


def _lexicon(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (entity, field, digits, label, n) sorted by the first three."""
    now, typed, out = None, [], []

    def close() -> None:
        for label, means in meanings(typed).items():
            out.append((now[0], now[1], label, [m for m, _ in means], [d for _, d in means]))

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        out.clear()
        types = [pa.string(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["e", "f", "label", "means", "letters"])

    for b in batches:
        for e, f, d, label, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (e, f, d) != now:
                if typed:
                    close()
                now, typed = (e, f, d), []
            typed.append((label, n))
        yield batch()
    if typed:
        close()
    yield batch()


def _signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sig = pa.array([digits(plain(x)) for x in b.column(2).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), sig, b.column(2), b.column(3)], names=["e", "f", "d", "label", "n"])


def lexicon(labels: DataFrame) -> DataFrame:
    """(e, f, label, n) to (e, f, label, means, letters): per entity and field what each typed label may mean."""
    sig = labels.mapInArrow(_signature, "e string, f int, d string, label string, n bigint")
    return sig.repartition("e", "f", "d").sortWithinPartitions("e", "f", "d").mapInArrow(_lexicon, "e string, f int, label string, means array<string>, letters array<int>")


_OUT = "e string, chunk bigint, kind int, ord bigint, means array<string>, letters array<bigint>, first bigint, last bigint, n bigint, total bigint"
_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
#: Rows of a stretch's result: a run that is done, or an event of the piece before its first certain boundary, of the
#: one behind its last, or of a stretch without any.
DONE, HEAD, WHOLE, TAIL = -1, 0, 1, 2
_AT_ONCE = 10_000


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_TYPES)
    rows.clear()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], names=[x.split()[0] for x in _OUT.split(", ")])


def _runs(e: str, events: list[_Event]) -> Iterator[tuple]:
    for s in _segmented(events):
        yield e, 0, DONE, 0, list(s.means), None, s.first, s.end, s.count, s.total


def _stretches(fields: int):
    """Rows (e, chunk, f, label, means, letters, p, r, d, l0, l1, ...) sorted by e, chunk, f, p, r.

    A stretch's labels stand before its events (f is then ``fields``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, Pieces(), []
        words: list[dict[str, list[tuple[str, int]]]] = [{} for _ in range(fields)]
        known: dict[tuple, dict[Meaning, int]] = {}

        def possible(labels: tuple[str, ...]) -> dict[Meaning, int]:
            got = known.get(labels)
            if got is None:
                got = {(): 0}
                for f, label in enumerate(labels):
                    got = {(*k, m): v + d for k, v in got.items() for m, d in words[f][label]}
                known[labels] = got
            return got

        def border(kind: int, events: list[_Event]) -> None:
            for i, x in enumerate(events):
                out.append((now[0], now[1], kind, i, [w for m in x.possible for w in m], list(x.possible.values()), x.first, x.end, x.count, x.total))

        def close() -> None:
            if held.events:
                border(TAIL if held.cut else WHOLE, held.events)

        for b in batches:
            e, chunk, f, label, means, letters, p, d, *ls = (c.to_pylist() for c in b.columns)
            for i in range(b.num_rows):
                if (e[i], chunk[i]) != now:
                    close()
                    now, held = (e[i], chunk[i]), Pieces()
                    words, known = [{} for _ in range(fields)], {}
                if f[i] < fields:
                    words[f[i]][label[i]] = list(zip(means[i], letters[i], strict=True))
                    continue
                done = held.add(p[i], d[i], possible(tuple(x[i] for x in ls)))
                if done is not None:
                    if held.cut:
                        out.extend(_runs(now[0], done))
                    else:
                        border(HEAD, done)
                    held.cut = True
            if len(out) >= _AT_ONCE:
                yield _batch(out)
        close()
        yield _batch(out)

    return run


def _borders(fields: int):
    """Events (e, block, means, letters, first, last, n, total) sorted by e, block and their order, to runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, Segmenter(), []

        def close() -> None:
            out.extend((now[0], 0, DONE, 0, list(s.means), None, s.first, s.end, s.count, s.total) for s in held.segments())

        for b in batches:
            for e, block, means, letters, first, last, n, total in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (e, block) != now:
                    if now is not None:
                        close()
                    now, held = (e, block), Segmenter()
                held.add(_Event(first, last, n, total, {tuple(means[fields * k : fields * (k + 1)]): v for k, v in enumerate(letters)}))
            if len(out) >= _AT_ONCE:
                yield _batch(out)
        if now is not None:
            close()
        yield _batch(out)

    return run


def collapse_runs(df: DataFrame, entity: str, position: str, length: str, row: str, labels: list[str], width: int = CHUNK) -> DataFrame:
    """One row per run: entity, the labels it means, first, last, n (its rows) and total (their lengths).

    Left out are rows with a null entity, label or position, a position below 0, or a length that is null or below 1.
    Rows equal in everything but ``row`` count once, as the one with the least ``row``.  Events of an entity are ordered
    by position, then ``row``.  Labels mean the same where ``labels.meanings`` says so within the entity.  ``df`` has to
    hold what makes rows different, and nothing else: all its columns are compared (those that aren't used by 128 bits
    of hash).  The result doesn't depend on ``width``.
    """
    ok = F.lit(True)
    for c in (entity, position, *labels):
        ok = ok & F.col(c).isNotNull()
    fields, ls = len(labels), [f"l{i}" for i in range(len(labels))]
    rest = [x for c in df.columns if c not in (entity, position, length, row, *labels) for x in (F.col(c).isNull(), F.col(c))]
    rows = df.filter(ok & (F.col(length) >= 1) & (F.col(position) >= 0)).select(
        F.col(entity).alias("e"),
        F.floor(F.col(position) / width).alias("chunk"),
        F.col(position).cast("bigint").alias("p"),
        F.col(row).alias("r"),
        F.col(length).cast("bigint").alias("d"),
        *[F.col(c).alias(x) for c, x in zip(labels, ls, strict=True)],
        F.xxhash64(*rest).alias("h0") if rest else F.lit(0).alias("h0"),
        F.xxhash64(F.lit("again"), *rest).alias("h1"),
    )
    # Shuffled by stretch: rows that are equal meet there, and the grouping needs no other shuffle.
    rows = store(rows.repartition("e", "chunk").groupBy("e", "chunk", "p", "d", *ls, "h0", "h1").agg(F.min("r").alias("r")).drop("h0", "h1"))

    pair = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(x).alias("label")) for i, x in enumerate(ls)]))
    typed = rows.select("e", "chunk", pair.alias("x")).groupBy("e", "chunk", "x.f", "x.label").agg(F.count(F.lit(1)).alias("n"))
    words = lexicon(typed.groupBy("e", "f", "label").agg(F.sum("n").alias("n")).select("e", "f", "label", "n"))
    # Each stretch gets the meanings of the labels that stand in it, and its events bare.
    known = typed.select("e", "chunk", "f", "label").join(words, ["e", "f", "label"])
    none = [F.lit(None).cast("string").alias(x) for x in ls]
    known = known.select("e", "chunk", "f", "label", "means", "letters", F.lit(0).cast("bigint").alias("p"), F.lit(None).cast(rows.schema["r"].dataType).alias("r"), F.lit(0).cast("bigint").alias("d"), *none)
    events = rows.select("e", "chunk", F.lit(fields).alias("f"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("array<string>").alias("means"), F.lit(None).cast("array<int>").alias("letters"), "p", "r", "d", *ls)
    both = known.unionByName(events).repartition("e", "chunk").sortWithinPartitions("e", "chunk", "f", "p", "r")
    out = store(both.drop("r").mapInArrow(_stretches(fields), _OUT))

    # What depends on the neighbours: a block begins behind a stretch's last certain boundary and ends before the next.
    border = out.filter(F.col("kind") != DONE)
    w = Window.partitionBy("e").orderBy("chunk", "kind")
    block = border.filter("ord = 0").select(F.col("e").alias("e_"), F.col("chunk").alias("c_"), F.col("kind").alias("k_"), F.sum((F.col("kind") == TAIL).cast("bigint")).over(w).alias("block"))
    border = border.join(block, (F.col("e") == F.col("e_")) & (F.col("chunk") == F.col("c_")) & (F.col("kind") == F.col("k_")))
    border = border.select("e", "block", "means", "letters", "first", "last", "n", "total", "chunk", "kind", "ord").repartition("e", "block").sortWithinPartitions("e", "block", "chunk", "kind", "ord").drop("chunk", "kind", "ord")
    runs = out.filter(F.col("kind") == DONE).unionByName(border.mapInArrow(_borders(fields), _OUT))
    return runs.select(F.col("e").alias(entity), *[F.get("means", F.lit(i)).alias(c) for i, c in enumerate(labels)], "first", "last", "n", "total")
