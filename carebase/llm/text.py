"""Column helpers that the operators on texts share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 20
# Everything but ASCII digits, ASCII letters and non-ASCII characters separates words.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WHITE = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other characters as they are.

    ``lower`` also changes other letters, so it serves texts of ASCII characters only; it is
    several times faster than ``translate``.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def pieces(text: Column, separator: str) -> Column:
    """The non-empty parts of ``text`` between matches of ``separator``; null has none."""
    parts = F.array_remove(F.split(text, separator, -1), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def words(text: Column) -> Column:
    """Lower-cased words of ASCII letters, digits and non-ASCII characters."""
    return pieces(ascii_lower(text), NON_WORD)


def hash_bitmap(df: DataFrame, value: str, bits: int = BITMAP_BITS) -> Column:
    """A bitmap of the hashes of ``value``, as a constant of fixed size for any number of rows.

    Test members with ``in_bitmap``: true for every value of ``df`` and for a few others.
    """
    hashed = df.select(F.pmod(F.xxhash64(value), F.lit(2**bits)).alias("h"))
    filled = hashed.groupBy(F.shiftright("h", 6).alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("word")
    )
    slots = df.sparkSession.range(2 ** (bits - 6)).withColumnRenamed("id", "slot")
    ordered = slots.join(filled, "slot", "left").agg(
        F.array_sort(F.collect_list(F.struct("slot", F.coalesce("word", F.lit(0)).alias("word"))))
        .alias("all")
    )
    return ordered.select(F.col("all.word")).scalar()


def in_bitmap(bitmap: Column, value: Column, bits: int = BITMAP_BITS) -> Column:
    h = F.pmod(F.xxhash64(value), F.lit(2**bits))
    return F.getbit(F.get(bitmap, F.shiftright(h, 6).cast("int")), h.bitwiseAND(63).cast("int")) == 1
