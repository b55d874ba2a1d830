"""SQL expressions shared by the operators.

They are texts for ``expr`` and ``selectExpr``: one call per expression, where the Column
API makes a round trip to the JVM for every node, which adds up on wide tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from carebase.datasets import MISSING_TOKENS

BAD_VALUE_MODES = ("raise", "null")


def check_bad_value_mode(mode: str) -> str:
    if mode not in BAD_VALUE_MODES:
        raise ValueError(f"on_bad_value must be one of {BAD_VALUE_MODES}, not {mode!r}")
    return mode


def quoted(name: str) -> str:
    """A column name that may hold any character."""
    escaped = name.replace("`", "``")
    return f"`{escaped}`"


def null_if_missing(name: str) -> str:
    """The text as it stands, or null where it is only a missing-value token.

    Blanks around a token do not matter; a kept value keeps its own blanks. Texts longer
    than any token are kept without folding their case.
    """
    column = quoted(name)
    text, longest = f"trim({column})", max(map(len, MISSING_TOKENS))
    kept = f"octet_length({text}) > {longest} or lower({text}) not in {MISSING_TOKENS}"
    return f"case when {kept} then {column} end"


def number_or_date(name: str, data_type: str, on_bad_value: str = "raise") -> str:
    """Text as ``data_type``, missing-value tokens as null.

    The cast is tried first and tokens are looked for only where it finds nothing, since
    most cells of a number column are numbers. ``nan`` is a token too, but would pass as a
    double.
    """
    value = f"try_cast({quoted(name)} as {data_type})"
    if data_type in ("double", "float"):
        value = f"nullif({value}, {data_type}('NaN'))"
    if check_bad_value_mode(on_bad_value) == "null":
        return value
    return f"coalesce({value}, cast({null_if_missing(name)} as {data_type}))"


def typed(name: str, data_type: str, on_bad_value: str = "raise") -> str:
    """Cast that fails the job on bad text, or turns it into null when asked to."""
    cast = "try_cast" if check_bad_value_mode(on_bad_value) == "null" else "cast"
    return f"{cast}({quoted(name)} as {data_type})"


def strict_total(names: Sequence[str]) -> str:
    """Row total that is null as soon as one part is null."""
    return " + ".join(names)


def filled_total(names: Sequence[str]) -> str:
    """Row total that counts null parts as zero."""
    return " + ".join(f"coalesce({name}, 0D)" for name in names)


def ratio(part: str, whole: str) -> str:
    """``part / whole``, null where ``whole`` is zero."""
    return f"({part}) / nullif({whole}, 0)"


def month_start(day: str, on_bad_value: str = "raise") -> str:
    """First day of the month of a yyyymmdd text, as a timestamp without zone."""
    parse = "try_to_date" if check_bad_value_mode(on_bad_value) == "null" else "to_date"
    return f"cast(trunc({parse}(cast({day} as string), 'yyyyMMdd'), 'MM') as timestamp_ntz)"


def month_start_between(first: str, last: str) -> str:
    """The same for the first and last yyyymmdd number seen in one calendar month.

    Both must be real days, else the job fails. Days of a month follow each other without
    gaps, so that covers all numbers in between.
    """
    real = f"({last} is null or {_as_date(last)} is not null)"
    return f"cast(case when {real} then trunc({_as_date(first)}, 'MM') end as timestamp_ntz)"


def _as_date(number: str) -> str:
    # make_date refuses days and months that do not exist. A month of 0 makes it refuse
    # numbers that do not have eight digits as well.
    return (
        f"make_date(cast({number} div 10000 as int), cast(if({number} between 10000101 and "
        f"99991231, {number} div 100 % 100, 0) as int), cast({number} % 100 as int))"
    )
