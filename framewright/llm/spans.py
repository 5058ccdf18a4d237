"""Long exact spans that texts share.

1. Exact copies, told by the 128 bits of the text's MD5, become one class, known by the least of their keys.
2. Each class's text is winnowed by code points: of each ``WINDOW`` consecutive hashes of ``GRAM`` code points the
   smallest is kept.  A shared span of ``SPAN`` holds a hash that both texts kept; hashes kept by two or more classes
   nominate recurring phrases.
3. The nominated texts are streamed, shard by shard, through an Aho-Corasick automaton of their phrases, which locates
   every occurrence with its surroundings.
4. Occurrences of one phrase are compared by their surroundings alone: phrase, common left and common right together
   make ``SPAN`` or more.  A phrase that very many classes hold isn't compared pair by pair but by the hashes of all
   windows of ``SPAN`` around it, which spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.hashing import gram_hashes, window_minima
from framewright.operators.intervals import periods_and_gaps
from framewright.session import store

SPAN, GRAM = 300, 200
#: Occurrences of one phrase up to which they are compared pair by pair.
COMPARED = 48
#: Members of a group that one task pairs with all of the group.
PAIRED = 1000
#: Characters of text whose phrases go into one automaton.
SHARD_CHARS = 400_000


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def anchors(text: str, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes (as signed) and their positions."""
    h = gram_hashes(code_points(text), gram)
    at = window_minima(h, span - gram + 1)
    return h[at].view(np.int64), at


def _nominate(gram: int, span: int, compared: int):
    """One row per place, but no more of one text and phrase than decide how the phrase is compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, hashes = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                h, times = np.unique(anchors(t, gram, span)[0], return_counts=True)
                h = np.repeat(h, np.minimum(times, compared + 1))
                at.append(np.full(len(h), i))
                hashes.append(h)
            if at:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes)), b.column(0).take(pa.array(np.concatenate(at)))], names=["h", "cid"])

    return run


_OCCURRENCE = "h binary, cid {}, at bigint, until bigint, lead string, rest string, many boolean"


def _locate(gram: int, span: int, shard: int):
    """Where the phrases nominated for a shard of texts stand in any of its texts.

    Neighbouring places with the same surroundings, as in a text that repeats itself, are one row: at to until.
    """
    reach = span - gram
    names = [x.split()[0] for x in _OCCURRENCE.split(", ")]

    def one(texts: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        types = [pa.binary(), kind, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        machine = ahocorasick.Automaton()
        for _, text, wanted in texts:
            many = {w["h"]: w["many"] for w in wanted}
            for h, at in zip(*(x.tolist() for x in anchors(text, gram, span)), strict=True):
                if h in many:
                    # The phrase's own 128 bits replace the hash that nominated it: only equal phrases are compared.
                    phrase = text[at : at + gram]
                    machine.add_word(phrase, (xxhash.xxh3_128_digest(phrase.encode("utf-8", "surrogatepass")), many[h]))
        machine.make_automaton()
        rows: list[list] = []
        for cid, text, _ in texts:
            open_: dict[tuple, list] = {}
            for end, (h, many) in machine.iter(text):
                s, e = end + 1 - gram, end + 1
                around = (h, text[max(0, s - reach) : s], text[e : e + reach])
                row = open_.get(around)
                if row is not None and s <= row[3] + gram:
                    row[3] = s
                    continue
                open_[around] = row = [h, cid, s, s, around[1], around[2], many]
                rows.append(row)
        cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars, kind = [], 0, pa.null()
        for b in batches:
            kind = b.column(0).type
            for row in zip(*(x.to_pylist() for x in b.columns), strict=True):
                held.append(row)
                chars += len(row[1])
                if chars >= shard:
                    yield one(held, kind)
                    held, chars = [], 0
        if held:
            yield one(held, kind)

    return run


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] agrees, a[:hi] doesn't
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


_LINK = "a {0}, b {0}, a_first bigint, a_last bigint, b_first bigint, b_last bigint"


def _compare(gram: int, span: int):
    """Rows come sorted by phrase.  A link names both classes and what they share around this phrase."""
    need = span - gram

    def links(group: list[tuple]) -> Iterator[tuple]:
        for i, (ca, sa, ua, la, ra) in enumerate(group):
            for cb, sb, ub, lb, rb in group[i + 1 :]:
                if ca == cb:
                    continue
                left, right = _common(la, lb), _common(ra, rb)
                if left + right >= need:
                    x = (ca, cb, sa - left, ua + gram + right - 1, sb - left, ub + gram + right - 1)
                    yield x if ca < cb else (cb, ca, *x[4:], *x[2:4])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, out, kind = None, [], [], pa.null()

        def close() -> None:
            out.extend(links(group))

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, kind if k < 2 else pa.int64()) for k, c in enumerate(cols)], names=[x.split()[0] for x in _LINK.split(", ")])

        for b in batches:
            kind = b.column(1).type
            for h, cid, at, until, lead, rest in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if h != now:
                    close()
                    now, group = h, []
                group.append((cid, at, until, lead[::-1], rest))
            yield batch()
        close()
        yield batch()

    return run


def _long_enough(docs: DataFrame, doc: str, text: str, span: int) -> DataFrame:
    t = docs.filter(F.col(doc).isNotNull() & (F.length(text) >= span))
    return t.select(F.col(doc).alias("doc"), F.unhex(F.md5(F.col(text))).alias("digest"), F.col(text).alias("t"))


def classes(docs: DataFrame, doc: str, text: str, span: int = SPAN) -> DataFrame:
    """Columns doc, cid, copies, chars: the class of exact copies of each document that is long enough to share a span.

    A class's id is the least key of its documents: keys have to be unique.  A document without a key has no class.
    """
    t = _long_enough(docs, doc, text, span).select("doc", "digest", F.length("t").cast("bigint").alias("chars"))
    per = t.groupBy("digest").agg(F.min("doc").alias("cid"), F.count(F.lit(1)).alias("copies"))
    return t.join(per, "digest").select("doc", "cid", "copies", "chars")


def _occurrences(docs: DataFrame, c: DataFrame, doc: str, text: str, span: int, gram: int, compared: int, shard: int) -> DataFrame:
    """Every place of every phrase that two or more classes hold; ``many`` where it has more than ``compared`` places.

    Of each class of ``c`` the document that names it is read.
    """
    texts = _long_enough(docs, doc, text, span).select(F.col("doc").alias("cid"), "t")
    t = texts.join(c.filter("doc = cid").select("cid"), "cid", "left_semi")
    kind = t.schema["cid"].dataType.simpleString()
    kept = store(t.mapInArrow(_nominate(gram, span, compared), f"h bigint, cid {kind}"))
    n = kept.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("lo"), F.max("cid").alias("hi")).filter("lo <> hi")
    two = n.filter("n = 2").select("h", F.explode(F.array("lo", "hi")).alias("cid"), F.lit(False).alias("many"))
    more = n.filter("n > 2").select(F.col("h").alias("k"), (F.col("n") > compared).alias("many"))
    more = kept.join(more, F.col("h") == F.col("k")).select("h", "cid", "many")
    wanted = two.unionByName(more).groupBy("cid").agg(F.collect_set(F.struct("h", "many")).alias("wanted"))
    return texts.join(wanted, "cid").select("cid", "t", "wanted").mapInArrow(_locate(gram, span, shard), _OCCURRENCE.format(kind))


def _links(docs: DataFrame, c: DataFrame, doc: str, text: str, span: int = SPAN, gram: int = GRAM, compared: int = COMPARED, shard: int = SHARD_CHARS) -> tuple[DataFrame, DataFrame]:
    """Links of phrases compared pair by pair, and the windows of the others: w is equal where a window's text is."""
    found = store(_occurrences(docs, c, doc, text, span, gram, compared, shard))
    few = found.filter(~F.col("many")).select("h", "cid", "at", "until", "lead", "rest").repartition("h").sortWithinPartitions("h")
    few = few.mapInArrow(_compare(gram, span), _LINK.format(found.schema["cid"].dataType.simpleString()))
    need = span - gram
    hot = found.filter("many").withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(need))))
    hot = hot.filter((F.length("lead") >= F.col("o")) & (F.length("rest") >= need - F.col("o")))
    # Equal in both hashes: 128 bits of the window's text, by its phrase's digest and what stands around it.
    window = [F.col("h"), F.col("o"), F.expr("right(lead, o)"), F.expr(f"left(rest, {need} - o)")]
    w = [F.xxhash64(F.lit(k), *window).alias(f"w{k}") for k in range(2)]
    hot = hot.select(*w, "cid", (F.col("at") - F.col("o")).alias("first"), (F.col("until") - F.col("o") + span - 1).alias("last"))
    return few, hot


def _window_groups(hot: DataFrame) -> DataFrame:
    """Windows that two or more classes hold; s0 and s1 are equal where the classes are the same."""
    once = hot.select("w0", "w1", "cid").distinct()
    return once.groupBy("w0", "w1").agg(F.count(F.lit(1)).alias("n"), *[F.bit_xor(F.xxhash64(F.lit(k), "cid")).alias(f"s{k}") for k in range(2)]).filter("n > 1")


def _paired(t: DataFrame, keys: list[str], who: str, n: str) -> DataFrame:
    """Columns x < y: each two members ``who`` of one group, of which ``n`` tells the size.

    A group is dealt out in parts of about ``PAIRED``, and each part meets the whole group in a task of its own.
    """
    parts = F.ceil(F.col(n) / PAIRED).cast("int")
    left = t.select(*keys, F.col(who).alias("x"), F.pmod(F.xxhash64(who), parts).cast("int").alias("_part"))
    right = t.select(*keys, F.col(who).alias("y"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    return left.join(right, [*keys, "_part"]).filter("x < y").select("x", "y")


def class_pairs(docs: DataFrame, c: DataFrame, doc: str, text: str, span: int = SPAN, **how) -> DataFrame:
    """Each two classes (of ``classes``) of different texts (a < b) that share ``span`` code points or more; none is lost."""
    few, hot = _links(docs, c, doc, text, span, **how)
    # Of the windows that the same classes hold one tells who is linked.
    one = _window_groups(hot).dropDuplicates(["s0", "s1", "n"]).select("w0", "w1", "n")
    members = hot.select("w0", "w1", "cid").distinct().join(one, ["w0", "w1"])
    linked = _paired(members, ["w0", "w1"], "cid", "n").withColumnsRenamed({"x": "a", "y": "b"})
    return few.select("a", "b").unionByName(linked.select("a", "b")).distinct()


def shared_pairs(docs: DataFrame, doc: str, text: str, span: int = SPAN, **how) -> DataFrame:
    """Each two different documents with ``span`` consecutive code points in common, as doc_id_a < doc_id_b.

    Null, empty and shorter texts, and documents without a key, have none.  Links are found between classes of copies;
    what is written out for the documents of linked classes, and for the copies of one class, is the result itself.
    """
    c = store(classes(docs, doc, text, span))
    pairs = class_pairs(docs, c, doc, text, span, **how)
    left, right = c.select(F.col("doc").alias("x"), F.col("cid").alias("a")), c.select(F.col("doc").alias("y"), F.col("cid").alias("b"))
    across = pairs.join(left, "a").join(right, "b").select("x", "y")
    within = _paired(c.filter("copies > 1"), ["cid"], "doc", "copies")
    both = across.unionByName(within)
    return both.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))


def shared_chars(docs: DataFrame, doc: str, text: str, span: int = SPAN, **how) -> DataFrame:
    """Columns doc, class_id, copies, shared_chars: one row per document that shares a span with another.

    shared_chars counts its code points that lie in any span of ``span`` or more that stands in another document too;
    for a document with exact copies that is the whole text.
    """
    c = store(classes(docs, doc, text, span))
    few, hot = _links(docs, c, doc, text, span, **how)
    few = few.select(F.explode(F.array(F.struct(F.col("a").alias("cid"), F.col("a_first").alias("first"), F.col("a_last").alias("last")), F.struct(F.col("b").alias("cid"), F.col("b_first").alias("first"), F.col("b_last").alias("last")))).alias("x")).select("x.*")
    hot = hot.join(_window_groups(hot).select("w0", "w1"), ["w0", "w1"], "left_semi").select("cid", "first", "last")
    parts = periods_and_gaps(few.unionByName(hot), ["cid"], "first", "last").filter("kind = 'period'")
    shared = parts.groupBy("cid").agg(F.sum(F.col("last") - F.col("first") + 1).alias("shared"))
    out = c.join(shared, "cid", "left").filter((F.col("copies") > 1) | F.col("shared").isNotNull())
    shared_chars = F.when(F.col("copies") > 1, F.col("chars")).otherwise(F.col("shared"))
    return out.select(F.col("doc").alias(doc), F.col("cid").alias("class_id"), "copies", shared_chars.alias("shared_chars"))
