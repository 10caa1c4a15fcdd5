"""Model feature names to reader-facing reasons, as Catalyst expressions over a name column."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright.functions.expressions import ColumnLike, as_column
from casewright.vocabulary import FEATURE_REASONS, OTHER_FEATURE, OTHER_REASON, SENSITIVE_FEATURES

PREFIX = r"^(num|cat)__"
LEVEL_SUFFIX = r"_[0-9]+$"


def base_feature(column: ColumnLike) -> Column:
    """Lower-case name without its transformer prefix and one trailing numeric level."""
    name = as_column(column)
    stripped = F.regexp_replace(F.regexp_replace(F.lower(name), PREFIX, ""), LEVEL_SUFFIX, "")
    return F.when(name != OTHER_FEATURE, stripped)


def _literal_pairs(mapping: Sequence[tuple[str, str]]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("reason")) for k, v in mapping])


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, although inner lambdas use it for every key."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def reason_of(column: ColumnLike, mapping: Sequence[tuple[str, str]] = FEATURE_REASONS) -> Column:
    """Reason for a feature name: exact key, else the first key that contains it or is contained in it.

    An empty or missing name has no reason.
    """
    pairs = _literal_pairs(mapping)

    def lookup(name: Column) -> Column:
        exact = F.get(F.filter(pairs, lambda p: p["key"] == name), F.lit(0))["reason"]
        partial = F.get(
            F.filter(pairs, lambda p: F.contains(name, p["key"]) | F.contains(p["key"], name)), F.lit(0)
        )["reason"]
        return F.when(name != "", F.coalesce(exact, partial, F.lit(OTHER_REASON))).otherwise(OTHER_REASON)

    return _bound(base_feature(column), lookup)


def attribute_of(column: ColumnLike, mapping: Sequence[tuple[str, str]] = FEATURE_REASONS) -> Column:
    """The longest known attribute that the name equals or extends with ``_``; else the name itself."""
    keys = sorted({k for k, _ in mapping} | set(SENSITIVE_FEATURES), key=lambda k: (-len(k), k))
    known = F.array(*[F.lit(k) for k in keys])

    def lookup(name: Column) -> Column:
        matches = F.filter(known, lambda k: (name == k) | F.startswith(name, F.concat(k, F.lit("_"))))
        return F.coalesce(F.get(matches, F.lit(0)), name)

    return _bound(base_feature(column), lookup)


def is_sensitive(column: ColumnLike, sensitive: Sequence[str] = SENSITIVE_FEATURES) -> Column:
    return F.coalesce(attribute_of(column).isin(*sensitive), F.lit(False))


def describe_names(
    names: Sequence[str], mapping: Sequence[tuple[str, str]] = FEATURE_REASONS, sensitive: Sequence[str] = SENSITIVE_FEATURES
) -> list[tuple[str, str, bool]]:
    """(name, reason, sensitive) for column names that are known while planning."""
    known = sorted({k for k, _ in mapping} | set(sensitive), key=len, reverse=True)
    exact = dict(mapping)
    described = []
    for raw in names:
        name = re.sub(LEVEL_SUFFIX, "", re.sub(PREFIX, "", raw.lower()))
        partial = (reason for key, reason in mapping if key in name or name in key)
        reason = exact.get(name) or (next(partial, OTHER_REASON) if name else OTHER_REASON)
        attribute = next((k for k in known if name == k or name.startswith(k + "_")), name)
        described.append((raw, reason, attribute in sensitive))
    return described
