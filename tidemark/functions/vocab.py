"""Ordered keyword rules over lower-cased text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(low: Column, words: Sequence[str]) -> Column:
    """True if any of the words occurs in the lower-cased text."""
    return reduce(or_, [low.contains(w.lower()) for w in words])


def first_match(low: Column, ordered: Mapping[str, str]) -> Column:
    """Label of the first key (in mapping order) contained in ``low``, else NULL."""
    out = None
    for needle, label in ordered.items():
        hit = low.contains(needle.lower())
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def first_group(low: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Name of the first group any of whose words occurs, else NULL."""
    out = None
    for name, words in groups.items():
        hit = contains_any(low, words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def tier_score(low: Column, tiers: Mapping[int, Sequence[str]], base: int = 1) -> Column:
    """Highest tier any of whose words occurs, at least ``base``."""
    parts = [F.when(contains_any(low, words), F.lit(score)) for score, words in tiers.items()]
    return F.greatest(F.lit(base), *parts)
