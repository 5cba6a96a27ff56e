"""Ordered-rule classifiers: the first rule that matches decides."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, functions as F

from .text import _col, contains_any

# Java regexes fold case for ASCII only unless UNICODE_CASE is on: (?iu)
# makes 'ÁGUA' match 'água'.
UNICODE_NOCASE = "(?iu)"

_ATOM = re.compile(r"\[([^\[\]\\^&]+)\]|([^\\.^$*+?()\[\]{}|])")
# Characters for which _fold may not give what (?iu) compares.
_UNSAFE = re.compile("[^\u0000-ſ]|[µİıſ]")


def _members(cls: str) -> list[str] | None:
    """The characters of a class such as ``sc`` or ``1-4``; None where it is not a short plain list."""
    out, i = [], 0
    while i < len(cls):
        if i + 2 < len(cls) and cls[i + 1] == "-":
            out += [chr(c) for c in range(ord(cls[i]), ord(cls[i + 2]) + 1)]
            i += 3
        elif cls[i] == "-":
            return None
        else:
            out.append(cls[i])
            i += 1
    return out if 0 < len(out) <= 16 else None


def literal_alternatives(pattern: str, most: int = 64) -> list[str] | None:
    """The lower-cased texts that a pattern of literals, short classes and ``|`` stands for.

    ``ub[sc]|cras`` gives ``ubs``, ``ubc``, ``cras``. None for any other pattern.
    """
    out = []
    for branch in pattern.split("|"):
        atoms, at = [], 0
        while at < len(branch):
            m = _ATOM.match(branch, at)
            choice = None if m is None else _members(m[1]) if m[1] else [m[2]]
            if choice is None:
                return None
            atoms.append([c.lower() for c in choice])
            at = m.end()
        out += ["".join(p) for p in product(*atoms)]
        if len(out) > most:
            return None
    return None if any(_UNSAFE.search(x) for x in out) else list(dict.fromkeys(out))


def _fold(text: Column) -> Column:
    """Text in the case that (?iu) compares. ``lower`` differs from it in three letters that fold to i and s."""
    low = F.lower(F.replace(text, F.lit("İ"), F.lit("i")))
    return F.replace(F.replace(low, F.lit("ı"), F.lit("i")), F.lit("ſ"), F.lit("s"))


def first_match_regex(c: Column | str, rules: Sequence[tuple[str, str]], default: str,
                      flags: str = UNICODE_NOCASE) -> Column:
    """Label of the first unanchored pattern found in the text; null text reads as ''.

    Rules made of literals and short classes are compiled to plain text
    searches over the text folded once; if any rule is another pattern, all are
    regex searches. Both give the same labels.
    """
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    plain = [literal_alternatives(p) for p, _ in rules] if flags == UNICODE_NOCASE else [None]
    if not rules:
        return F.lit(default)

    def chain(conditions: list[Column]) -> Column:
        out = F.when(conditions[0], F.lit(rules[0][1]))
        for cond, (_, label) in zip(conditions[1:], rules[1:], strict=True):
            out = out.when(cond, F.lit(label))
        return out.otherwise(F.lit(default))

    if None in plain:
        return chain([text.rlike(flags + p) for p, _ in rules])
    # in a projection Spark evaluates the folded text once for all searches, and compiles them
    folded = _fold(text)
    return chain([contains_any(folded, x) for x in plain])


def first_match_set(c: Column | str, groups: Sequence[tuple[Sequence[str], str]],
                    default: str) -> Column:
    """Label of the first value set holding the value; null or unknown → default."""
    c = _col(c)
    out = None
    for values, label in groups:
        cond = c.isin(list(values))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))
