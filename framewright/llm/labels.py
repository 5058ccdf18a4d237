"""Typed labels: their plain form, and which of them mean the same."""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterable

# Letters whose plain form Unicode doesn't give by decomposition.
PLAIN_LETTERS = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ŧ": "t", "ı": "i", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d"})

#: Rows of a form from which it can't be a slip of a form that stands less than ``SLIP_SHARE`` ** -1 times as often.
OFTEN, SLIP_SHARE = 3, 0.2


def plain(text: str) -> str:
    """Without case, accents, spaces and punctuation."""
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).casefold()).translate(PLAIN_LETTERS)
    return "".join(c for c in text if c.isalnum())


def digits(form: str) -> str:
    """The digits alone: a letter mistyped between them doesn't change them."""
    return "".join(c for c in form if c.isdigit())


def within_one(a: str, b: str) -> bool:
    """Whether at most one letter is missing, added or replaced."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def one_less(form: str) -> set[str]:
    """The form and what is left of it without any one letter: forms within one letter of each other share one."""
    return {form, *(form[:i] + form[i + 1 :] for i in range(len(form)))}


def meanings(typed: Iterable[tuple[str, int]]) -> dict[str, list[tuple[str, int]]]:
    """For each typed label the proper labels it may mean, each with the number of letters that differ (0 or 1).

    ``typed`` has each label with its number of rows.  A form that stands often enough is proper; a rare one within a
    letter of a proper one, digits agreeing, is a slip of it.  Two rare forms that are two letters apart may both be
    slips of a form that nobody typed; then both mean the first of them.  A proper form is shown as its most frequent
    typing.  Only forms that share a ``one_less`` are compared.
    """
    count: dict[str, int] = defaultdict(int)
    shown: dict[str, tuple[int, str]] = {}
    forms: dict[str, str] = {}
    for label, n in typed:
        f = forms[label] = plain(label) or label
        count[f] += n
        if f not in shown or (-n, label) < shown[f]:
            shown[f] = (-n, label)
    shares: dict[str, list[str]] = defaultdict(list)
    for f in count:
        for k in one_less(f):
            shares[k].append(f)
    around = {f: sorted({p for k in one_less(f) for p in shares[k] if p != f and digits(p) == digits(f)}) for f in count}
    near = {f: [p for p in ps if within_one(p, f)] for f, ps in around.items()}
    means: dict[str, list[tuple[str, int]]] = {}
    # Of forms that stand equally often the one that has more others within a letter is the proper one of them.
    for f in sorted(count, key=lambda x: (-count[x], -len(near[x]), x)):
        proper = {p for p in around[f] if means.get(p) == [(p, 0)]}
        slips = [p for p in near[f] if p in proper and (count[f] < OFTEN or count[f] <= SLIP_SHARE * count[p])]
        if slips:
            means[f] = [(p, 1) for p in slips]
            continue
        means[f] = [(f, 0)]
        if count[f] == 1:
            # Forms that share a one_less but aren't within one letter are two apart, their common slip between them.
            pair = [p for p in around[f] if p in proper and count[p] == 1]
            if pair:
                means[f] = [(pair[0], 1)]
    return {label: [(shown[p][1], d) for p, d in means[f]] for label, f in forms.items()}
