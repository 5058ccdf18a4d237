"""Text that was decoded with the wrong character encoding.

A value's encoding chain (how its bytes were written, and what they were read as) is latent.  Each chain that a value
can be undone by gives a candidate text; another one are the values that a chain would have turned into it, letters that
got lost on the way included.  Expectation maximisation weighs the candidates by the chain's share within the value's
source and field and by a character model of the corpus, and estimates both from the weighed candidates of all records.
A record is damaged where its posterior says that it isn't as it was written, and is repaired by the best candidate.

The character model has a fixed number of hashed counts, and the shares are joined by source and field: what is sent to
the tasks doesn't grow with the data.
"""

from __future__ import annotations

import math
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.session import store

# Encodings that texts are read as by mistake, and single-byte ones that they were written in.
READ_AS = ("cp1252", "latin_1", "iso8859_15", "cp437", "cp850", "mac_roman", "cp1250", "iso8859_2", "cp1251", "cp1253", "cp1254", "koi8_r", "cp866")
WRITTEN_IN = ("cp1252", "cp1250", "cp1251", "cp1253", "mac_roman")
CHAINS = [f"utf_8>{d}" for d in READ_AS] + [f"utf_8>{d}>utf_8>{d}" for d in ("cp1252", "latin_1")] + [f"{e}>{d}" for e in WRITTEN_IN for d in READ_AS if e != d and (e, d) != ("cp1252", "latin_1")]
CLEAN, LOST = "clean", "lost"

#: Counts of the character model.
SLOTS = 1 << 20
#: Rounds of expectation maximisation at most, and the part of the damaged share that may still change when they end.
ROUNDS, SETTLED = 10, 0.001
#: Records of a source and field, or of the corpus, that weigh as much as what is expected of them.
SHARE_RECORDS = 50
_FIRST_CLEAN = 0.9


@lru_cache(maxsize=None)
def _tables(codec: str) -> tuple[list[str], dict[str, int]]:
    """Character of each byte, and byte of each character; undefined bytes are the control characters they are."""
    chars = []
    for b in range(256):
        try:
            chars.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            chars.append(chr(b))
    back = {c: b for b, c in enumerate(chars)}
    for b in range(128, 160):
        back.setdefault(chr(b), b)
    return chars, back


def _undo_utf8(text: str, codec: str) -> str | None:
    """Stretches that are well-formed UTF-8 in ``codec`` are decoded, whatever stands around them stays."""
    back = _tables(codec)[1]
    data = [back.get(c, -1) for c in text]
    out, i, n, done = [], 0, len(text), False
    while i < n:
        b = data[i]
        size = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
        part = data[i : i + size]
        if size and len(part) == size and all(0x80 <= x <= 0xBF for x in part[1:]):
            try:
                out.append(bytes(part).decode("utf_8"))
                i, done = i + size, True
                continue
            except UnicodeDecodeError:
                pass
        out.append(text[i])
        i += 1
    return "".join(out) if done else None


def undo(text: str, chain: str) -> str | None:
    """What ``text`` was before the chain, or None where the chain can't have led to it."""
    steps = chain.split(">")
    for e, d in zip(steps[-2::-2], steps[::-2], strict=True):
        if e == "utf_8":
            got = _undo_utf8(text, d)
        else:
            chars, back = _tables(e)[0], _tables(d)[1]
            got = "".join(c if c < "\x80" or c not in back else chars[back[c]] for c in text)
        if got is None or got == text:
            return None
        text = got
    return text


def damage(text: str, chain: str) -> str | None:
    """What the chain makes of ``text``, or None where the text can't be written so."""
    steps = chain.split(">")
    for e, d in zip(steps[::2], steps[1::2], strict=True):
        try:
            data = text.encode(e)
        except UnicodeEncodeError:
            return None
        chars = _tables(d)[0]
        text = "".join(chars[b] for b in data)
    return text


def losses(text: str, chain: str) -> list[str]:
    """What may be left of the damaged text: all of it, or all but its control characters."""
    got = damage(text, chain)
    if got is None or got == text:
        return []
    kept = "".join(c for c in got if not "\x7f" <= c <= "\x9f")
    return [got] if kept == got else [got, kept]


def _key(text: str) -> str:
    return text.casefold().strip(" ")


def mask(text: str) -> str:
    """With the replacement character in the place of every letter beyond ASCII."""
    return "".join(c if c < "\x80" else "�" for c in unicodedata.normalize("NFC", text)).casefold().strip(" ")


# -- the character model ---------------------------------------------------------------------------------------------

# Classes of characters, how many each has, and how likely one follows another.
_KINDS = "ascii", "space", "digit", "mark", "accented", "greek", "cyrillic", "letter", "symbol", "control"
_SIZE = {"ascii": 26, "space": 1, "digit": 10, "mark": 30, "accented": 120, "greek": 50, "cyrillic": 60, "letter": 3000, "symbol": 400, "control": 60}
_OWN_SCRIPT = ("greek", "cyrillic", "letter")


@lru_cache(maxsize=100_000)
def kind(c: str) -> str:
    if c.isascii():
        return "ascii" if c.isalpha() else "digit" if c.isdigit() else "space" if c in " ^$" else "mark"
    if c == "�" or unicodedata.category(c) in ("Cc", "Cf", "Cn", "Co"):
        return "control"
    if c in "ªºµ" or not c.isalpha() or unicodedata.decomposition(c).startswith("<"):
        return "symbol"
    name = unicodedata.name(c, "")
    for script in ("LATIN", "GREEK", "CYRILLIC"):
        if name.startswith(script):
            return {"LATIN": "accented"}.get(script, script.lower())
    return "letter"


@lru_cache(maxsize=None)
def follows(a: str, b: str) -> float:
    """How likely a character of kind ``b`` is after one of kind ``a``."""
    if b == "control":
        return 1e-6
    if b == "symbol":
        return 1e-6
    if a in _OWN_SCRIPT or b in _OWN_SCRIPT:
        if a == b:
            return 0.8
        if {a, b} <= {*_OWN_SCRIPT, "ascii", "accented"}:
            return 1e-5
        return 0.02 if b in _OWN_SCRIPT else 0.1
    if b == "accented":
        return 0.01 if a == "accented" else 0.04
    return {"ascii": 0.7, "space": 0.12, "digit": 0.01, "mark": 0.02}[b]


def _slot(gram: str) -> int:
    return xxhash.xxh32_intdigest(gram) % SLOTS


def level(text: str) -> str:
    """The text as the character model sees it: typings that differ in case, form or outer blanks are the same."""
    return unicodedata.normalize("NFC", text).lower().replace("i̇", "i").replace("ı", "i").strip(" ")


def grams(text: str) -> list[str]:
    t = f"^{level(text)}$"
    return [t[max(0, i - 2) : i + 1] for i in range(1, len(t))]


@lru_cache(maxsize=200_000)
def _slots(text: str) -> tuple[tuple[float, int, int, int, int], ...]:
    """Of each character of ``text``: its prior, and the slots of its trigram, bigram and both contexts."""
    out = []
    for g in grams(text):
        a, c = g[-2], g[-1]
        prior = follows(kind(a), kind(c)) / _SIZE[kind(c)]
        out.append((prior, _slot("3" + g), _slot("2" + g[-2:]), _slot("c" + g[:-1]), _slot("b" + a)))
    return tuple(out)


def likelihood(text: str, counts: dict[int, float], value: str = "", own: float = 0.0) -> float:
    """Log-likelihood of a text that ``value`` may have been; ``own`` occurrences of that are taken out of the counts.

    A trigram can't stand more often than the bigrams in it: the smallest count is the one least disturbed by others
    in its slot.
    """
    out = 0.0
    mine = {x for _, *slots in _slots(value) for x in slots} if own else ()
    for prior, *slots in _slots(text):
        tri, bi, ctx, one = [max(counts.get(i, 0.0) - own, 0.0) if i in mine else counts.get(i, 0.0) for i in slots]
        bi = min(bi, one)
        p = (bi + prior) / (one + 1)
        out += math.log((min(tri, bi, ctx) + p) / (ctx + 1))
    return out


def tally(text: str, weight: float, into: dict[int, float]) -> None:
    for _, *slots in _slots(text):
        for s in slots:
            into[s] += weight


# -- expectation maximisation ----------------------------------------------------------------------------------------


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value) to (value, chain, text, level): what each chain undone makes of it, in its own and in upper case."""
    for b in batches:
        rows: set[tuple] = set()
        for v in b.column(0).to_pylist():
            for form in {v, v.upper() if v == v.lower() else v}:
                for chain in CHAINS:
                    got = undo(form, chain)
                    if got is not None and _key(got) != _key(v) and not any(kind(c) == "control" for c in got):
                        rows.add((v, chain, got if form == v else got.lower(), level(got)))
        yield _batch(sorted(rows), ["value", "chain", "text", "level"], [pa.string()] * 4)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def _damaged_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (key, chain, text): what each chain would make of it."""
    for b in batches:
        rows = []
        for t in b.column(0).to_pylist():
            rows += [(_key(x), c, t) for c in CHAINS for x in losses(t, c)]
            rows.append((mask(t), LOST, t))
        yield _batch(rows, ["key", "chain", "text"], [pa.string()] * 3)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = b.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([_key(x) for x in v], pa.string()), pa.array([level(x) for x in v], pa.string())], names=["value", "total", "key", "level"])


def expected(chain: str) -> float:
    """A chain's share before anything is known."""
    return _FIRST_CLEAN if chain == CLEAN else (1 - _FIRST_CLEAN) / len(CHAINS)


#: Chains by number, as the tables hold them.
NAMES = (CLEAN, LOST, *CHAINS)
_NUMBER = {c: i for i, c in enumerate(NAMES)}
#: Values whose candidates are weighed in one step.
_AT_ONCE = 500

_LAID = "value string, lost boolean, chains array<int>, texts array<string>, own array<double>, lens array<int>, priors array<double>, slots array<int>, mine array<int>"


def proves_nothing(chain: str, undone: bool, seen: float, total: float) -> bool:
    """Whether a value's own occurrences prove nothing of it against a candidate that stands ``seen`` times.

    They don't where the candidate stands more often, nor where well-formed UTF-8 of another reading gave it, which clean
    text doesn't hold: whatever a slip's share is, it grows with the corpus, and so does this.
    """
    return seen > total or (undone and chain.startswith("utf_8"))


def _lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, total, cands) to the candidates with the slots of all their characters, those of the value in front.

    Of candidates that are equally likely the last one counts: what is undone of the value as it is typed.  ``mine`` tells by bits which of a character's four slots are the value's own too.
    """
    types = [pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    for b in batches:
        rows = []
        for value, total, cands in zip(*(c.to_pylist() for c in b.columns), strict=True):
            cands = sorted(cands or [], key=lambda c: (c["chain"], c["undone"], c["undone"] and c["text"] == undo(value, c["chain"]), c["text"]))
            lens, priors, slots, mine = [], [], [], []
            own = {x for _, *four in _slots(value) for x in four}
            for text in (value, *(c["text"] for c in cands)):
                of = _slots(text)
                lens.append(len(of))
                for prior, *four in of:
                    priors.append(prior)
                    slots += four
                    mine.append(sum(1 << k for k, x in enumerate(four) if x in own))
            lost = any(kind(c) == "control" for c in value)
            rows.append((value, lost, [_NUMBER[c["chain"]] for c in cands], [c["text"] for c in cands], [float(total) if proves_nothing(c["chain"], c["undone"], c["seen"] or 0, total) else 0.0 for c in cands], lens, priors, slots, mine))
        yield _batch(rows, [x.split()[0] for x in _LAID.split(", ")], types)


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many of each."""
    behind = np.cumsum(n)
    return np.arange(behind[-1] if len(n) else 0) + np.repeat(start - (behind - n), n)


def _flat(b: pa.RecordBatch, column: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False)


def _sizes(b: pa.RecordBatch, column: str) -> np.ndarray:
    return pc.list_value_length(b.column(b.schema.get_field_index(column))).to_numpy(zero_copy_only=False).astype(np.int64)


def _fitting(b: pa.RecordBatch, model: np.ndarray) -> np.ndarray:
    """Of each candidate the log-likelihood, less that of the value as it stands, own occurrences left out of both."""
    own, lens = _flat(b, "own"), _flat(b, "lens").astype(np.int64)
    n_texts, n_cands = _sizes(b, "lens"), _sizes(b, "own")
    if not len(own):
        return own
    value_at = np.repeat(np.cumsum(n_texts) - n_texts, n_cands)
    cand_at = _ranges(np.cumsum(n_texts) - n_texts + 1, n_cands)
    t = np.concatenate([cand_at, value_at])
    starts = np.cumsum(lens) - lens
    at = _ranges(starts[t], lens[t])
    off = np.repeat(np.concatenate([own, own]), lens[t])
    slots = _flat(b, "slots").reshape(-1, 4)[at]
    mine = (_flat(b, "mine")[at][:, None] >> np.arange(4)) & 1
    counts = model[slots]
    counts = np.where(mine == 1, np.maximum(counts - off[:, None], 0), counts)
    tri, bi, ctx, one = counts.T
    bi = np.minimum(bi, one)
    p = (bi + _flat(b, "priors")[at]) / (one + 1)
    each = np.log((np.minimum(np.minimum(tri, bi), ctx) + p) / (ctx + 1))
    total = np.add.reduceat(each, np.cumsum(lens[t]) - lens[t])
    return total[: len(own)] - total[len(own) :]


_FIT = "value string, lost boolean, chains array<int>, fits array<double>"


def _fit(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, _AT_ONCE):
                b = whole.slice(s, _AT_ONCE)
                offsets = np.concatenate([[0], np.cumsum(_sizes(b, "own"))])
                fits = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(_fitting(b, model.value)))
                yield pa.RecordBatch.from_arrays([*b.select(["value", "lost", "chains"]).columns, fits], names=["value", "lost", "chains", "fits"])

    return run


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lens, slots, at, w), with the texts' places in ``lens`` and their weights, to the slots' counts of this task."""
    into = np.zeros(SLOTS)
    for b in batches:
        lens, n = _flat(b, "lens").astype(np.int64), _sizes(b, "lens")
        t = _flat(b, "at").astype(np.int64) + np.repeat(np.cumsum(n) - n, _sizes(b, "at"))
        starts = np.cumsum(lens) - lens
        slots = _flat(b, "slots").reshape(-1, 4)[_ranges(starts[t], lens[t])]
        into += np.bincount(slots.ravel(), np.repeat(_flat(b, "w"), 4 * lens[t]), SLOTS)
    held = np.flatnonzero(into)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(into[held])], names=["slot", "w"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, weight) to the slots' counts of this task."""
    into: dict[int, float] = defaultdict(float)
    for b in batches:
        for t, w in zip(*(c.to_pylist() for c in b.columns), strict=True):
            tally(t, w, into)
    yield _batch(list(into.items()), ["slot", "w"], [pa.int32(), pa.float64()])


def _model(fixed: DataFrame, laid: DataFrame, weights: DataFrame):
    """Counts of the weighed texts (value, at, w) added to the fixed ones, sent to the tasks: SLOTS numbers."""
    per = weights.filter("w > 0").groupBy("value").agg(F.collect_list(F.struct("at", "w")).alias("x"))
    texts = laid.select("value", "lens", "slots").join(per, "value").select("lens", "slots", F.col("x.at").alias("at"), F.col("x.w").alias("w"))
    both = fixed.unionByName(texts.mapInArrow(_tally, "slot int, w double"))
    got = both.groupBy("slot").agg(F.sum("w").alias("w")).toArrow()
    model = np.zeros(SLOTS)
    model[got["slot"].to_numpy()] = got["w"].to_numpy()
    return fixed.sparkSession.sparkContext.broadcast(model)


def _posterior(rows: DataFrame, priors: Column) -> DataFrame:
    """Rows (source, field, value, n, lost, chains, fits) to (source, field, value, n, chains, at, p): who was it, how sure.

    ``at`` is a candidate's place among the value's texts: 0 is the value as it stands, -1 a text that can't be told.  A
    control or replacement character was never written: then the value isn't the text as it was.
    """
    k = F.size("chains")
    clean, lost = F.lit(_NUMBER[CLEAN]), F.lit(_NUMBER[LOST])
    nobody = F.col("lost") & (k == 0)
    pick = lambda none, some, all_: F.when(nobody, none).when(F.col("lost"), some).otherwise(all_)
    places = F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>"))
    out = rows.select(
        "source",
        "field",
        "value",
        "n",
        priors.alias("priors"),
        pick(F.array(lost), F.col("chains"), F.concat(F.array(clean), "chains")).alias("chains"),
        pick(F.array(F.lit(-1)), places, F.concat(F.array(F.lit(0)), places)).alias("at"),
        pick(F.array(F.lit(0.0)), F.col("fits"), F.concat(F.array(F.lit(0.0)), "fits")).alias("fits"),
    )
    out = out.withColumn("score", F.zip_with("chains", "fits", lambda c, f: F.ln(F.get("priors", c)) + f))
    out = out.withColumn("e", F.transform("score", lambda x: F.exp(x - F.array_max("score"))))
    out = out.withColumn("z", F.aggregate("e", F.lit(0.0), lambda s, x: s + x))
    return out.select("source", "field", "value", "n", "chains", "at", F.transform("e", lambda x: x / F.col("z")).alias("p"))


def posterior(values: DataFrame, rounds: int = ROUNDS, settled: float = SETTLED) -> DataFrame:
    """(source, field, value, n) to each value's p_clean and its best other candidate: chain, text and p.

    Only values with a character beyond ASCII can be damaged; others are evidence of how texts are written.  Rounds end
    when the share of damaged records changes by no more than ``settled`` of itself, after ``rounds`` at the latest.
    """
    values = store(values)
    # A value is little to read and much to weigh: few bytes must not end up in few tasks.
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = lambda df: df.repartition(n, F.xxhash64("value"))
    plain = values.filter(~F.col("value").rlike("[^\\x00-\\x7f]"))
    odd = values.filter(F.col("value").rlike("[^\\x00-\\x7f]"))
    totals = odd.groupBy("value").agg(F.sum("n").alias("total"))
    keyed = store(spread(totals).mapInArrow(_keys, "value string, total bigint, key string, level string"))
    # What counts as a value's own are all its typings.
    levels = keyed.groupBy("level").agg(F.sum("total").alias("seen"))
    keyed = store(keyed.join(levels, "level").select("value", "key", "level", F.col("total").alias("n"), F.col("seen").alias("total")))
    undone = spread(keyed.select("value")).mapInArrow(_candidates, "value string, chain string, text string, level string").join(levels, "level", "left")
    undone = undone.select("value", "chain", "text", F.lit(True).alias("undone"), "seen")
    forms = spread(keyed.filter("total > 1").select("value")).mapInArrow(_damaged_forms, "key string, chain string, text string")
    forms = forms.join(keyed.select("key").distinct(), "key", "left_semi").join(keyed.select(F.col("value").alias("text"), F.col("total").alias("seen")), "text")
    redone = keyed.join(forms, "key").filter("seen > total")
    redone = redone.select("value", "chain", "text", F.lit(False).alias("undone"), "seen")
    # One candidate a chain and text: what was undone tells more than what was redone.
    cands = undone.unionByName(redone).groupBy("value", "chain", "text").agg(F.max("undone").alias("undone"), F.max("seen").alias("seen"))
    cands = cands.groupBy("value").agg(F.collect_list(F.struct("chain", "text", "undone", "seen")).alias("cands"))
    laid = store(spread(keyed.join(cands, "value", "left").select("value", "total", "cands")).mapInArrow(_lay, _LAID))

    base = plain.groupBy("value").agg(F.sum("n").cast("double").alias("w")).select("value", "w")
    fixed = store(base.mapInArrow(_counts, "slot int, w double").groupBy("slot").agg(F.sum("w").alias("w")))
    clean = plain.groupBy("source", "field").agg(F.sum("n").cast("double").alias("w")).select("source", "field", F.lit(_NUMBER[CLEAN]).alias("chain"), "w")
    model = _model(fixed, laid, keyed.select("value", F.lit(0).alias("at"), F.col("n").cast("double").alias("w")))
    shares, whole = None, [expected(c) for c in NAMES]
    for i in range(rounds):
        fits = laid.select("value", "lost", "chains", "own", "lens", "priors", "slots", "mine").mapInArrow(_fit(model), _FIT)
        rows = spread(odd.join(fits, "value"))
        if shares is None:
            post = store(_posterior(rows, F.array(*map(F.lit, whole))))
        else:
            post = store(_posterior(rows.join(shares, ["source", "field"], "left"), F.coalesce("priors", F.array(*map(F.lit, whole)))))
        each = post.select("source", "field", "value", "n", F.explode(F.arrays_zip("chains", "at", "p")).alias("x")).select("source", "field", "value", F.col("x.chains").alias("chain"), F.col("x.at").alias("at"), (F.col("n") * F.col("x.p")).alias("w"))
        got = store(each.unionByName(clean.withColumns({"value": F.lit(None).cast("string"), "at": F.lit(0)})).groupBy("source", "field", "chain").agg(F.sum("w").alias("w")))
        every = {r.chain: r.w for r in got.groupBy("chain").agg(F.sum("w").alias("w")).collect()}
        records, before = sum(every.values()), whole
        whole = [(every.get(k, 0.0) + SHARE_RECORDS * expected(c)) / (records + SHARE_RECORDS) for k, c in enumerate(NAMES)]
        damaged, was = 1 - whole[_NUMBER[CLEAN]], 1 - before[_NUMBER[CLEAN]]
        if i == rounds - 1 or abs(damaged - was) <= settled * damaged:
            break
        model = _model(fixed, laid, each.filter("at >= 0").groupBy("value", "at").agg(F.sum("w").alias("w")))
        held = got.groupBy("source", "field").agg(F.map_from_entries(F.collect_list(F.struct("chain", "w"))).alias("m"), F.sum("w").alias("records"))
        share = F.transform(F.array(*map(F.lit, whole)), lambda x, k: (F.coalesce(F.try_element_at("m", k), F.lit(0.0)) + SHARE_RECORDS * x) / (F.col("records") + SHARE_RECORDS))
        shares = held.select("source", "field", share.alias("priors"))
    p_clean = F.aggregate(F.zip_with("chains", "p", lambda c, p: F.when(c == _NUMBER[CLEAN], p).otherwise(0.0)), F.lit(0.0), lambda s, x: s + x)
    others = F.filter(F.arrays_zip("p", "chains", "at"), lambda x: x["at"] != 0)
    best = post.join(laid.select("value", "texts"), "value").select("source", "field", "value", "n", p_clean.alias("p_clean"), F.array_max(others).alias("b"), "texts")
    name = F.get(F.array(*map(F.lit, NAMES)), F.col("b.chains"))
    return best.select("source", "field", "value", "n", "p_clean", name.alias("chain"), F.when(F.col("b.at") > 0, F.get("texts", F.col("b.at") - 1)).alias("text"))


def damaged_fields(df: DataFrame, row: str, source: str, fields: list[str], rounds: int = ROUNDS) -> DataFrame:
    """Columns row, field, value, restored, chain, p: each field that wrong decoding changed.

    restored is null where the text can't be told.  Null and ASCII values are never damaged; rows that stand more than
    once are each reported; a null source is a source of its own.
    """
    cells = df.select(F.col(row).alias("row"), F.coalesce(F.col(source).cast("string"), F.lit("\x00null")).alias("source"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x"))
    cells = cells.select("row", "source", "x.field", "x.value").filter("value is not null")
    values = cells.groupBy("source", "field", "value").agg(F.count(F.lit(1)).alias("n"))
    bad = posterior(values, rounds).filter("p_clean < 0.5")
    odd = cells.filter(F.col("value").rlike("[^\\x00-\\x7f]"))
    out = odd.join(bad.drop("n"), ["source", "field", "value"])
    return out.select(F.col("row").alias(row), "field", "value", F.col("text").alias("restored"), "chain", (1 - F.col("p_clean")).alias("p"))
