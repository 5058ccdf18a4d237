"""Mapping typed values to the entries of a reference list.

Values and entry names become sets of tokens: each two neighbouring letters of the plain form, its ends included,
numbered where they repeat.  Tokens are ordered by how rare they are in the list.  Two sets of Jaccard similarity
``LIKE`` or more share one of their rarest tokens, so only prefixes meet; length and position rule out more, and what is
left is verified exactly.  Of the candidates the one that is explained by the fewest mistyped letters is kept.

What people put behind a name ("Ltd", "new", "no. 3") is learned from the values themselves: words that stand behind the
whole names of ``TAIL_ENTRIES`` or more entries.  A value is then also looked up without them.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.labels import plain

#: Jaccard similarity from which a name is a candidate.  Two mistyped letters in seven leave 0.33, in six 0.27.
LIKE = 0.27
#: Characters of names up to which the list goes to every task; a longer one is joined by a shuffle.
SENT_CHARS = 4 << 20
#: Letters of an abbreviated word at least.
SHORT = 3
#: Entries behind whose names the same words have to stand until they count as put behind a name, and how many words.
TAIL_ENTRIES, TAIL_WORDS = 3, 3

_TRANSLATED = str.maketrans({"&": " and ", "™": " tm ", "®": " ", "_": " "})


def words_of(text: str) -> list[str]:
    """Plain words; single letters with points between are one word; "and" is none."""
    text = re.sub(r"\b(?:\w\.){2,}", lambda m: m[0].replace(".", "") + " ", unicodedata.normalize("NFC", text).translate(_TRANSLATED))
    parts = (plain(w) for w in re.split(r"[^\w']+", text) if w)
    return [w for w in parts if w and w != "and"]


def spelt(text: str) -> str:
    """Letters without case and accents, but each still one letter."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if c.isalnum())


def tail(words: list[str]) -> str:
    """Words behind a name; numbers are alike."""
    return " ".join("#" if w.isdigit() else w for w in words)


def tokens_of(compact: str) -> frozenset[str]:
    if not compact:
        return frozenset()
    t = f"^{compact}$"
    seen: dict[str, int] = {}
    out = []
    for i in range(len(t) - 1):
        g = t[i : i + 2]
        n = seen[g] = seen.get(g, 0) + 1
        out.append(f"{g}{n}" if n > 1 else g)
    return frozenset(out)


#: Tokens that one mistyped letter takes from or adds to a set at most: a replaced one is in two, before and after; of a
#: swap there are three.
PER_LETTER = 6


def mistyped(a: str, b: str, most: int) -> int:
    """Letters missing, added, replaced or swapped with their neighbour; more than ``most`` give ``most + 1``.

    One column of the distance table at a time, as bits of an integer: what grows by one, and what shrinks, from cell to
    cell.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    if not a or not b:
        return min(max(len(a), len(b)), most + 1)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | (1 << i)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, zero, before, d = full, 0, 0, 0, len(a)
    for k, c in enumerate(b, 1):
        here = at.get(c, 0)
        swap = ((~zero & here) << 1) & before & full
        zero = ((((here & up) + up) ^ up) | here | down | swap) & full
        right_up = down | (full & ~(zero | up))
        right_down = zero & up
        if right_up & top:
            d += 1
        elif right_down & top:
            d -= 1
        if d - (len(b) - k) > most:  # each letter that is left takes off one at most
            return most + 1
        right_up = ((right_up << 1) | 1) & full
        right_down = (right_down << 1) & full
        up = right_down | (full & ~(zero | right_up))
        down = right_up & zero
        before = here
    return min(d, most + 1)


def allowed(length: int) -> int:
    """How many mistyped letters a name of so many letters may have."""
    return 0 if length < 4 else 1 if length < 6 else 2


class Entries:
    """The names of one kind with their inverted index of prefixes."""

    def __init__(self, names: list[tuple[int, str]], like: float = LIKE):
        self.like = like
        self.names: list[tuple[int, list[str], str, frozenset[str]]] = []
        self.spelt: list[str] = []
        for ref, name in names:
            w = words_of(name)
            compact = "".join(w) or name
            self.names.append((ref, w, compact, tokens_of(compact)))
            self.spelt.append(spelt(name))
        self.rarity = Counter(t for *_, tokens in self.names for t in tokens)
        self.index: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (*_, tokens) in enumerate(self.names):
            for i, t in enumerate(self.prefix(tokens)):
                self.index[t].append((n, i))

    def prefix(self, tokens: frozenset[str]) -> list[str]:
        order = sorted(tokens, key=lambda t: (self.rarity.get(t, 0), t))
        return order[: len(order) - math.ceil(self.like * len(order)) + 1]

    def candidates(self, tokens: frozenset[str]) -> Iterator[tuple[int, float]]:
        """Names whose token sets are like this one, with their similarity."""
        size, ruled = len(tokens), {}
        for i, t in enumerate(self.prefix(tokens)):
            for n, j in self.index.get(t, ()):
                if n in ruled:
                    continue
                other = len(self.names[n][3])
                if min(size, other) < self.like * max(size, other):
                    ruled[n] = False  # length
                    continue
                # position: this is the first token they share, so what follows it on either side is all they can share
                ruled[n] = min(size - i, other - j) >= self.like / (1 + self.like) * (size + other)
        for n, may in ruled.items():
            if may:
                other = self.names[n][3]
                shared = len(tokens & other)
                like = shared / (size + len(other) - shared)
                if like >= self.like:
                    yield n, like

    def meant(self, text: str, left_out: Iterable[int] = ()) -> int | None:
        """The entry that a typed value means, or None; also without as many words at the end as ``left_out`` says."""
        best = self.best(text, left_out)
        return None if best is None else best[-1]

    def best(self, text: str, left_out: Iterable[int] = ()) -> tuple[float, int, float, int] | None:
        """(mistyped letters, 1 where words behind the name were left out, less similarity, entry) of the best one."""
        whole = words_of(text)
        best: tuple | None = None
        for extra, w in enumerate(forms_of(whole, left_out)):
            compact = "".join(w)
            tokens = tokens_of(compact)
            for n, like in sorted(self.candidates(tokens), key=lambda x: -x[1]):
                ref, name, full, other = self.names[n]
                # how many tokens are only on one side, by the similarity
                apart = (len(tokens) + len(other)) * (1 - like) / (1 + like)
                d = self._distance(w, compact, name, full, apart)
                if d is None and not text.isascii():
                    # a mistyped letter whose plain form is two letters
                    d = mistyped(spelt(text), self.spelt[n], allowed(len(self.spelt[n])))
                    d = d if d <= allowed(len(self.spelt[n])) else None
                if d is not None and (best is None or (d, min(extra, 1), -like, ref) < best):
                    best = (float(d), min(extra, 1), -like, ref)
        return best

    @staticmethod
    def _distance(w: list[str], compact: str, name: list[str], full: str, apart: float) -> float | None:
        most = allowed(min(len(full), len(compact)))
        reach = PER_LETTER * most + 0.5
        d = mistyped(compact, full, most) if apart <= reach else most + 1
        # Words in another order: two tokens less and two more at each border between them.
        if d > 0 and len(name) > 1 and len(w) > 1 and apart <= reach + 4 * (len(w) + len(name)):
            d = min(d, mistyped("".join(w[::-1]), full, most), mistyped("".join(sorted(w)), "".join(sorted(name)), most))
        if d <= most:
            return d
        if len(w) == len(name) > 1 and len(w[-1]) >= SHORT and len(w[-1]) < len(name[-1]) and name[-1].startswith(w[-1]):
            d = mistyped("".join(w[:-1]), "".join(name[:-1]), 1)
            if d <= 1:
                return d + 0.5  # abbreviated
        return None


def forms_of(whole: list[str], left_out: Iterable[int]) -> list[list[str]]:
    """The words of a value, and without those at its end; at least the first word stays."""
    return [whole, *(whole[:-k] for k in sorted(left_out) if k < len(whole))] if whole else []


def _match(names: dict[str, list[tuple[int, str]]], like: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = {k: Entries(v, like) for k, v in names.items()}
        for b in batches:
            refs = []
            for k, v, left_out in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got = entries[k].meant(v, left_out or ()) if k in entries else None
                refs.append(-1 if got is None else got)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(refs, pa.int64())], names=["kind", "value", "ref_id"])

    return run


def _rows(rows: list[tuple], shape: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "array<string>": pa.list_(pa.string())}
    fields = [x.split() for x in shape.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


_SPLITS = "kind string, value string, left_out int, compact string, tail string"


def _splits(most: int):
    """(kind, value) to what is left of the value without its last words, none to ``most``, and what those are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for kind, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                w = words_of(v)
                rows += [(kind, v, k, "".join(w[: len(w) - k]), tail(w[len(w) - k :])) for k in range(min(most + 1, len(w)))]
            yield _rows(rows, _SPLITS)

    return run


def with_tails(once: DataFrame, ref: DataFrame, least: int = TAIL_ENTRIES, most: int = TAIL_WORDS) -> DataFrame:
    """(kind, value) with ``left_out``: how many words at its end are put behind a name, each way that this may be.

    Counted over all values: words behind the whole name of an entry, in values that aren't names as a whole.
    """
    splits = once.select("kind", "value").mapInArrow(_splits(most), _SPLITS)
    known = ref.select("kind", F.col("name").alias("value"), "ref_id")
    compact = known.select("kind", "value").distinct().mapInArrow(_splits(0), _SPLITS).select("kind", "value", "compact").join(known, ["kind", "value"]).select("kind", "compact", "ref_id").distinct()
    whole = splits.filter("left_out = 0").join(compact, ["kind", "compact"], "left_semi").select("kind", "value")
    behind = splits.filter("left_out > 0").join(whole, ["kind", "value"], "left_anti").join(compact, ["kind", "compact"])
    tails = behind.groupBy("kind", "tail").agg(F.countDistinct("ref_id").alias("n")).filter(F.col("n") >= least).select("kind", "tail")
    per = splits.filter("left_out > 0").join(tails, ["kind", "tail"], "left_semi").groupBy("kind", "value").agg(F.collect_set("left_out").alias("left_out"))
    return once.join(per, ["kind", "value"], "left").select("kind", "value", "left_out")


_TOKENS = "kind string, key string, extra int, size int, tokens array<string>"


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, text, left_out) to a row per form of the text with its tokens; the text itself stays behind."""
    for b in batches:
        rows = []
        for k, key, t, left_out in zip(*(c.to_pylist() for c in b.columns), strict=True):
            for extra, w in enumerate(forms_of(words_of(t), left_out or ())):
                tokens = sorted(tokens_of("".join(w)))
                if tokens:
                    rows.append((k, key, extra, len(tokens), tokens))
        yield _rows(rows, _TOKENS)


_SCORED = "kind string, value string, d double, extra int, unlike double, ref bigint"


def _explain(like: float):
    """(kind, value, left_out, ref_id, name) to how well the name explains the value; if it doesn't, to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for kind, value, left_out, ref, name in zip(*(c.to_pylist() for c in b.columns), strict=True):
                best = Entries([(ref, name)], like).best(value, left_out or ())
                if best is not None:
                    rows.append((kind, value, *best))
            yield _rows(rows, _SCORED)

    return run


def _joined(once: DataFrame, ref: DataFrame, like: float) -> DataFrame:
    """The same mapping where the list is too long to be sent: prefixes meet in an equi-join on kind and token."""
    keyed = once.select("kind", F.md5("value").alias("key"), "value", "left_out")
    listed = ref.select("kind", F.md5("name").alias("name_key"), "name", "ref_id")
    typed = keyed.mapInArrow(_tokenised, _TOKENS)
    names = listed.select("kind", "name_key", "name").distinct().withColumn("left_out", F.lit(None).cast("array<int>")).mapInArrow(_tokenised, _TOKENS)
    rarity = names.select("kind", F.explode("tokens").alias("token")).groupBy("kind", "token").agg(F.count(F.lit(1)).alias("n"))

    def prefixes(t: DataFrame) -> DataFrame:
        one = t.select("kind", "key", "extra", "size", F.explode("tokens").alias("token")).join(rarity, ["kind", "token"], "left")
        order = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")))
        keep = (F.col("size") - F.ceil(F.lit(like) * F.col("size")) + 1).cast("int")
        out = one.groupBy("kind", "key", "extra", "size").agg(order.alias("o"))
        return out.select("kind", "key", "extra", "size", F.posexplode(F.slice("o", F.lit(1), keep)).alias("at", "x")).select("kind", "key", "extra", "size", "at", "x.token")

    a = prefixes(typed)
    b = prefixes(names).select("kind", F.col("key").alias("name_key"), F.col("size").alias("other"), F.col("at").alias("other_at"), "token")
    near = a.join(b, ["kind", "token"]).filter(F.least("size", "other") >= like * F.greatest("size", "other"))
    # Of the tokens that two prefixes share the first one tells how many they can share at most.
    near = near.groupBy("kind", "key", "extra", "size", "name_key", "other").agg(F.min(F.struct("at", "other_at")).alias("x"))
    near = near.filter(F.least(F.col("size") - F.col("x.at"), F.col("other") - F.col("x.other_at")) >= like / (1 + like) * (F.col("size") + F.col("other")))
    near = near.select("kind", "key", "name_key").distinct().join(keyed, ["kind", "key"]).join(listed, ["kind", "name_key"])
    scored = near.select("kind", "value", "left_out", "ref_id", "name").mapInArrow(_explain(like), _SCORED)
    best = scored.groupBy("kind", "value").agg(F.min(F.struct("d", "extra", "unlike", "ref")).alias("b"))
    return once.join(best, ["kind", "value"], "left").select("kind", "value", F.coalesce("b.ref", F.lit(-1)).cast("bigint").alias("ref_id"))


def map_values(values: DataFrame, reference: DataFrame, like: float = LIKE, sent_chars: int = SENT_CHARS) -> DataFrame:
    """(kind, value) to (kind, value, ref_id), once per distinct value; ref_id is -1 where no entry is meant.

    ``reference`` has kind, ref_id, name and alt_names (joined by bars, may be null).  Its size is measured: up to
    ``sent_chars`` it is sent to the tasks, beyond that it is joined by a shuffle, with the same result.  Null values have
    no row; a value without any letter or digit means no entry.  Of entries that fit equally well the one with the
    smaller ref_id is taken.
    """
    ref = reference.select("kind", F.col("ref_id").cast("bigint").alias("ref_id"), F.explode(F.array_compact(F.concat(F.array("name"), F.coalesce(F.split("alt_names", "\\|"), F.array().cast("array<string>"))))).alias("name"))
    once = with_tails(values.select("kind", "value").filter("kind is not null and value is not null").distinct(), ref)
    chars = ref.agg(F.sum(F.length("name"))).first()[0] or 0
    if chars > sent_chars:
        return _joined(once, ref, like)
    names: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for r in ref.collect():
        names[r.kind].append((r.ref_id, r.name))
    # A value is little to read and much to compare: few bytes must not end up in one task.
    spread = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return once.repartition(spread, "value").mapInArrow(_match(dict(names), like), "kind string, value string, ref_id bigint")


def map_fields(df: DataFrame, row: str, fields: list[str], reference: DataFrame, **how) -> DataFrame:
    """Columns row, field, value, ref_id: every value of the fields that isn't written exactly as an entry's name.

    The field's name is the reference's kind.  Null values and values of white space alone are left out.
    """
    cells = df.select(F.col(row).alias("row"), F.explode(F.array(*[F.struct(F.lit(f).alias("kind"), F.col(f).alias("value")) for f in fields])).alias("x"))
    cells = cells.select("row", "x.kind", "x.value").filter(F.col("value").rlike("(?U)[^\\s\\x1c-\\x1f]"))
    cells = cells.join(reference.select("kind", F.col("name").alias("value")).distinct(), ["kind", "value"], "left_anti")
    meant = map_values(cells, reference, **how)
    return cells.join(meant, ["kind", "value"]).select(F.col("row").alias(row), F.col("kind").alias("field"), "value", "ref_id")
