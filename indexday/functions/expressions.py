"""Column expressions of the study vocabulary; all of them stay inside code generation."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from indexday.spec import CategoryRule


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_matches(code: Column | str, prefixes: Sequence[str] = (), codes: Sequence[str] = ()) -> Column:
    """True when a source code is one of ``codes``, or a prefix alone or with a dotted suffix."""
    tests = []
    if prefixes:
        stems = "|".join(re.escape(p) for p in prefixes)
        tests.append(_col(code).rlike(rf"^(?:{stems})(\.[A-Za-z0-9]|$)"))
    if codes:
        tests.append(_col(code).isin(*codes))
    return reduce(or_, tests) if tests else F.lit(False)


def in_window(date: Column | str, index: Column | str, before: int, after: int) -> Column:
    """``date`` lies from ``before`` days ahead of the index to ``after`` days behind it."""
    index = _col(index)
    return _col(date).between(F.date_sub(index, before), F.date_add(index, after))


def in_interval(date: Column | str, start: Column | str, end: Column | str) -> Column:
    return _col(date).between(_col(start), _col(end))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def year_age(date: Column | str, year_of_birth: Column | str) -> Column:
    """Age as the difference of calendar years."""
    return F.year(_col(date)) - _col(year_of_birth)


def matched(c: Column | str) -> Column:
    """1 where a left join found a partner, else 0."""
    return F.when(_col(c).isNotNull(), 1).otherwise(0)


def any_flag(*flags: str) -> Column:
    """True when one of the flags is 1; a NULL flag counts as 0."""
    return reduce(or_, [F.coalesce(F.col(f), F.lit(0)) == 1 for f in flags])


def categorize(rules: Sequence[CategoryRule], code: Column | str | None = None, value: Column | str | None = None) -> Column:
    """Label of the first rule that matches the code or the value; NULL when none does."""
    out = None
    for rule in rules:
        tests = []
        if rule.ids:
            tests.append(_col(code).isin(*rule.ids))
        if rule.values:
            tests.append(_col(value).isin(*rule.values))
        hit = reduce(or_, tests)
        out = F.when(hit, rule.label) if out is None else out.when(hit, rule.label)
    return F.lit(None).cast("string") if out is None else out


def threshold_label(c: Column | str, limit: int, upto: str, above: str) -> Column:
    """``upto`` for values of at most ``limit``, ``above`` beyond it, NULL for NULL."""
    return F.when(_col(c) <= limit, upto).when(_col(c) > limit, above)


def label_to_flag(c: Column | str, label: str) -> Column:
    """1 for the label, 0 for any other, NULL for NULL."""
    return F.when(_col(c) == label, 1).when(_col(c).isNotNull(), 0)


def relabel(c: Column | str, old: str | None, new: str) -> Column:
    """Replace one label (or NULL, with ``old=None``) by another."""
    c = _col(c)
    return F.coalesce(c, F.lit(new)) if old is None else F.when(c == old, new).otherwise(c)


def bin_labels(breaks: Sequence[int]) -> list[str]:
    """Names of the left-closed bins between the breaks; the last one is open to the right."""
    return [f"{a}-{b - 1}" for a, b in zip(breaks, breaks[1:])] + [f"{breaks[-1]}+"]


def cut(c: Column | str, breaks: Sequence[int], labels: Sequence[str] | None = None) -> Column:
    """Label of the left-closed bin a number falls in; NULL below the first break."""
    c = _col(c)
    labels = labels or bin_labels(breaks)
    out = F.when(c < breaks[0], F.lit(None).cast("string"))
    for upper, label in zip(breaks[1:], labels):
        out = out.when(c < upper, label)
    return out.when(c >= breaks[-1], labels[-1])


def strip_prefix(c: Column | str, prefix: str) -> Column:
    """The text without a leading prefix, in lower case."""
    return F.lower(F.regexp_replace(_col(c), f"^{re.escape(prefix)}", ""))
