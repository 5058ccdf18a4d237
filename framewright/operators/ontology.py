"""Keyword rules over texts: which official names a post mentions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One alternative of an official name; kind is ``keyword``, ``secondary`` or ``unwanted``."""

    team: str
    official: str
    alternative: str
    kind: str = "keyword"


def parse_rules(text: str) -> list[Rule]:
    """A team's line, then tab-indented ``official <= a|b``; ``$$$ `` secondary and ``*** `` unwanted alternatives.

    ``^`` stands for a blank; alternatives are lower case; blank lines are skipped.
    """
    team, out = "", []
    for line in text.splitlines():
        if not line.strip():
            continue
        if not line.startswith("\t"):
            team = line.strip()
            continue
        body = line.strip()
        kind = "secondary" if body.startswith("$$$") else "unwanted" if body.startswith("***") else "keyword"
        body = body[3:].strip() if kind != "keyword" else body
        official, _, alts = body.partition("<=")
        for a in (alts or official).split("|"):
            if a.strip():
                out.append(Rule(team, official.strip(), a.strip("\t ").lower().replace("^", " "), kind))
    return out


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """The rules of a text file, or of all files of a folder: a list that people write, held by the driver."""
    texts = spark.read.text(path, wholetext=True).orderBy("_metadata.file_path").toLocalIterator()
    return [r for t in texts for r in parse_rules(t.value or "")]


class _Contained:
    """Which of many phrases a text holds: one automaton over all of them where the library is there, else one by one."""

    def __init__(self, phrases: Iterable[str]):
        self.phrases = sorted({p for p in phrases if p})
        try:
            import ahocorasick
        except ImportError:
            self.machine = None
            return
        self.machine = ahocorasick.Automaton()
        for p in self.phrases:
            self.machine.add_word(p, p)
        if self.phrases:
            self.machine.make_automaton()

    def __call__(self, text: str) -> set[str]:
        if not self.phrases:
            return set()
        return {p for p in self.phrases if p in text} if self.machine is None else {p for _, p in self.machine.iter(text)}

    def any(self, text: str) -> bool:
        if not self.phrases:
            return False
        return any(p in text for p in self.phrases) if self.machine is None else next(self.machine.iter(text), None) is not None


def _longest(r: Rule) -> tuple:
    return -len(r.alternative.split()), -len(r.alternative), r.team, r.official, r.alternative


class Mentions:
    """Rules made ready once, for many posts."""

    def __init__(self, rules: list[Rule]):
        self.unwanted = sorted((r for r in rules if r.kind == "unwanted"), key=_longest)
        self.plain = sorted((r for r in rules if r.kind == "keyword" and "." not in r.alternative), key=_longest)
        self.patterns = [(r, re.compile(r.alternative)) for r in rules if r.kind == "keyword" and "." in r.alternative]
        self.second: dict[str, list[str]] = {}
        for r in rules:
            if r.kind == "secondary":
                self.second.setdefault(r.team, []).append(r.alternative)
        # A post that holds none of these stays as it is, and has no mention.
        self.worth = _Contained(r.alternative for r in (*self.unwanted, *self.plain))

    def __call__(self, text: str | None, user: str | None) -> list[tuple[str, str, str]]:
        """(team, official, alternative) of one post, each alternative at most once.

        Unwanted phrases are taken out first, longest first.  A keyword counts where it and a secondary phrase of its
        team stand in the text or the user's name; it is then taken out, so that shorter phrases within it don't count
        again.  Alternatives with a point are patterns: what they match in this text are further alternatives.
        """
        post, name = (text or "").lower().strip(), (user or "").lower()
        if not self.patterns and not self.worth.any(post) and not self.worth.any(name):
            return []
        for r in self.unwanted:
            post = post.replace(r.alternative, "")
        found = [Rule(r.team, r.official, m) for r, p in self.patterns for m in dict.fromkeys(x[0] for x in p.finditer(post)) if m]
        bare = name.replace("_", "")
        out = []
        for r in sorted([*self.plain, *found], key=_longest) if found else self.plain:
            if (r.alternative in post or r.alternative in name) and any(s in post or s in bare for s in self.second.get(r.team, ())):
                out.append((r.team, r.official, r.alternative))
                post, name = post.replace(r.alternative, ""), name.replace(r.alternative, "")
                bare = name.replace("_", "")
        return out


def mentions(rules: list[Rule], text: str | None, user: str | None) -> list[tuple[str, str, str]]:
    """The mentions of one post, see ``Mentions``."""
    return Mentions(rules)(text, user)


def find_mentions(posts: DataFrame, rules: list[Rule], key: str, text: str, user: str) -> DataFrame:
    """Columns key, text_id (1-based within the post), team, official, keyword."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Mentions(rules)
        for b in batches:
            at, rows = [], []
            for i, (t, u) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                for n, m in enumerate(ready(t, u)):
                    at.append(i)
                    rows.append((n + 1, *m))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = [pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=["key", "text_id", "team", "official", "keyword"])

    kind = posts.schema[key].dataType.simpleString()
    return posts.select(key, text, user).mapInArrow(run, f"`{key}` {kind}, text_id int, team string, official string, keyword string")


def contains_rules(posts: DataFrame, rules: list[Rule], key: str, text: str) -> DataFrame:
    """Columns key, official of every keyword that stands in a text: plain containment, in one pass for all rules."""
    officials: dict[str, set[str]] = {}
    for r in rules:
        if r.kind == "keyword" and "." not in r.alternative:
            officials.setdefault(r.alternative, set()).add(r.official)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Contained(officials)
        for b in batches:
            at, rows = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                for o in sorted({o for p in held(t) for o in officials[p]}) if t else ():
                    at.append(i)
                    rows.append(o)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(rows, pa.string())], names=[key, "official"])

    # Lower case is made in the JVM, as it is in the SQL of tables.
    low = posts.select(key, F.lower(F.col(text)).alias("_low"))
    return low.mapInArrow(run, f"`{key}` {posts.schema[key].dataType.simpleString()}, official string")


def relabel(value: Column, rules: list[tuple[str, str]]) -> Column:
    """The label of the last rule whose alternative stands in the value; else the value."""
    out = value
    for alternative, label in rules:
        out = F.when(F.contains(F.lower(value), F.lit(alternative.lower())), F.lit(label)).otherwise(out)
    return out
