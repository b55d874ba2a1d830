"""Column-name rules. They work on the header, never on rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame

_SEPARATORS = str.maketrans(" \t-/", "____")
_OTHER = re.compile("[^a-z0-9_]")


def normalize_name(header: str) -> str:
    """Lower-case words joined by single underscores; ``col`` when nothing is left."""
    kept = _OTHER.sub("", header.lower().translate(_SEPARATORS))
    return "_".join(word for word in kept.split("_") if word) or "col"


def unique_names(names: Iterable[str]) -> list[str]:
    """The n-th repeat of ``x`` becomes ``x_n``; a taken name moves on to the next free number."""
    seen: Counter[str] = Counter()
    taken: dict[str, None] = {}
    for name in names:
        seen[name] += 1
        candidate = name if seen[name] == 1 else f"{name}_{seen[name]}"
        while candidate in taken:
            seen[name] += 1
            candidate = f"{name}_{seen[name]}"
        taken[candidate] = None
    return list(taken)


def normalize_names(headers: Iterable[str]) -> list[str]:
    return unique_names(normalize_name(header) for header in headers)


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))
