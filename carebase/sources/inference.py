"""Column types of text, found by an aggregate and kept in a registry.

Every cell has a kind, such as a whole number that fits an int, or a date; the kinds of a column
are collected as the bits of one number. So types are found by ``bit_or``, in whatever pass reads
the text anyway, combine over tasks, files and runs in any order, and cost eight bytes a column. A
type is read off the bits at the end; the rules are those of Spark's own CSV inference. Two cases differ,
in which Spark's type depends on the order of the rows: longs beside whole numbers of 19 digits that do
not fit a long are ``decimal(20,0)``, and numbers such as ``5.`` are doubles.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carebase.datasets import ID_COLUMNS
from carebase.functions.columns import quoted
from carebase.functions.names import normalize_name
from carebase.session import written
from carebase.sources.versions import Version, VersionLog

INT, LONG, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(7))
# Whole numbers beyond a long have a bit for their number of digits each, up to 38.
FIRST_DIGITS, MOST_DIGITS = 19, 38
_DIGITS_SHIFT = 7
LONG_DIGITS = 20
DIGITS = sum(1 << (_DIGITS_SHIFT + i) for i in range(MOST_DIGITS - FIRST_DIGITS + 1))
NUMBERS = INT | LONG | DOUBLE | DIGITS

_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?(NaN|Infinity|(([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?)[fFdD]?)$|^-?Inf$"
_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def kind_bits(name: str) -> str:
    """The bit of a cell's kind, as SQL; 0 for null and empty cells, which tell nothing."""
    cell = quoted(name)
    digits = f"length(trim(LEADING '0' FROM trim(LEADING '+-' FROM {cell})))"
    big = f"shiftleft(1L, cast({_DIGITS_SHIFT - FIRST_DIGITS} + {digits} as int))"
    return f"""case
        when {cell} is null or {cell} = '' then 0L
        when {cell} rlike '{_WHOLE}' then
          case when try_cast({cell} as int) is not null then {INT}L
               when try_cast({cell} as bigint) is not null then {LONG}L
               when {digits} <= {MOST_DIGITS} then {big}
               else {DOUBLE}L end
        when trim({cell}) rlike '{_NUMBER}' then {DOUBLE}L
        when lower({cell}) in ('true', 'false') then {BOOLEAN}L
        when {cell} rlike '{_DATE}' and try_cast({cell} as date) is not null then {DATE}L
        when try_cast({cell} as timestamp) is not null then {TIMESTAMP}L
        else {TEXT}L end"""


def type_of(bits: int) -> str:
    """The narrowest type that takes all kinds of ``bits``; text if there were no cells."""
    if bits and not bits & ~NUMBERS:
        if bits & DOUBLE:
            return "double"
        if bits & DIGITS:
            most = (bits >> _DIGITS_SHIFT).bit_length() + FIRST_DIGITS - 1
            return f"decimal({max(most, LONG_DIGITS) if bits & LONG else most},0)"
        return "bigint" if bits & LONG else "int"
    if bits and not bits & ~(DATE | TIMESTAMP):
        return "timestamp" if bits & TIMESTAMP else "date"
    return "boolean" if bits == BOOLEAN else "string"


def kinds_of(names: list[str]) -> list[Column]:
    """One aggregate per column, by position, for ``agg`` or ``observe``."""
    return [F.expr(f"bit_or({kind_bits(name)})").alias(f"c{i}") for i, name in enumerate(names)]


def types_of(bits: Mapping[str, int]) -> dict[str, str]:
    """Types by column name; id columns are text whatever they hold."""
    ids = {name for name in bits if normalize_name(name) in ID_COLUMNS}
    return {name: "string" if name in ids else type_of(b) for name, b in bits.items()}


def merged(known: Mapping[str, int], seen: Mapping[str, int]) -> dict[str, int]:
    return {name: known.get(name, 0) | seen.get(name, 0) for name in {**known, **seen}}


def stored_as_text(raw: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The one pass over the files: ``raw``, text columns and the file of each row as the last one,
    stored under names of their own; and the kinds seen in each column but the last."""
    names = raw.columns[:-1]
    cells = [f"c{i}" for i in range(len(names))]
    seen = Observation()
    stored = written(raw.toDF(*cells, "file").observe(seen, *kinds_of(cells)), "raw_text")
    counted = seen.get
    bits = {name: counted[c] or 0 for name, c in zip(names, cells, strict=True)}
    return stored, bits


def as_types(stored: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Stored text with the names and types of ``types``, by position; the file stays last."""
    *cells, file = stored.columns
    typed = [
        cell if kind == "string" else f"cast(nullif({cell}, '') as {kind})"
        for cell, kind in zip(cells, types.values(), strict=True)
    ]
    return stored.selectExpr(*typed, file).toDF(*types, file)


class SchemaRegistry:
    """The kinds seen in each column of a dataset so far, over all runs."""

    def __init__(self, spark: SparkSession, root: str, dataset: str):
        self.log = VersionLog(spark, f"{root.rstrip('/')}/_schemas/{dataset}")

    def bits(self) -> dict[str, int]:
        version = self.log.latest()
        return dict(version.content["columns"]) if version else {}

    def add(self, bits: Mapping[str, int], *, replace: bool = False) -> list[str]:
        """Merges what a run has seen, or puts it in place; says what changed, by column.

        Nothing is stored when nothing is new.
        """
        version: Version | None = self.log.latest()
        known = dict(version.content["columns"]) if version else {}
        now = dict(bits) if replace else merged(known, bits)
        before, after = types_of(known), types_of(now)
        drift = [
            f"{name}: {before.get(name, 'absent')} to {after.get(name, 'absent')}"
            for name in before | after
            if known and before.get(name) != after.get(name)
        ]
        if now != known:
            self.log.commit(version, {"columns": now})
        return drift
