"""Column-name normalisation (metadata only)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

MAX_LENGTH = 255


def _snake(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_")


def normalized(name: str, style: str = "keepword", percent: bool = True) -> str:
    """``keepword`` drops apostrophes and spells out ``%``; ``sanitize`` turns both into separators."""
    if style == "keepword":
        text = name.replace("'", "")
        return _snake(text.replace("%", "pct") if percent else text)
    if style == "sanitize":
        return _snake(name)[:MAX_LENGTH]
    raise ValueError(f"unknown style {style!r}")


def numbered(names: Iterable[str]) -> list[str]:
    """Second and later uses of a name get the first free one of ``_1``, ``_2``, ..."""
    wanted = list(names)
    taken, result = set(wanted), []
    for name in wanted:
        free = name
        if name in result:
            free = next(f"{name}_{i}" for i in range(1, len(wanted) + len(taken) + 1) if f"{name}_{i}" not in taken)
        taken.add(free)
        result.append(free)
    return result


def normalize_columns(df: DataFrame, style: str = "keepword", dedupe: bool = False, percent: bool = True) -> DataFrame:
    names = [normalized(c, style, percent) for c in df.columns]
    if dedupe:
        names = numbered(names)
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after normalisation: {clashes}")
    return df.toDF(*names)
