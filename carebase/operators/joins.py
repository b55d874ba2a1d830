"""Left join that stays spread out when one key holds much of the right side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SLICE, _PRESENT = "__slice", "__present"


def sliced_left_join(
    left: DataFrame,
    right: DataFrame,
    right_keys: DataFrame,
    key: str,
    slice_on: Sequence[str],
    slices: int,
) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` with each key's right rows cut into slices.

    Adaptive execution can split a hot key on the kept side of a left join, but not on
    the other one. Here the right rows of a key are spread over up to ``slices`` tasks by
    a hash of ``slice_on``. A left row is repeated once for each slice its key really
    has, so every repeat finds a partner; a left row without partner is kept once.

    ``right_keys`` is any frame with the same distinct (``key``, ``slice_on``) values as
    ``right``; it only has to be cheaper to compute. Its slices are folded into one short list
    per key in front of the shuffle. One slice is the plain join.
    """
    if slices < 1:
        raise ValueError(f"slices must be at least 1, not {slices}")
    if slices == 1:
        return left.join(right, key, "left")
    slice_of = f"cast(pmod(xxhash64({', '.join(slice_on)}), {slices}) as int)"
    present = right_keys.groupBy(key).agg(F.expr(f"collect_set({slice_of})").alias(_PRESENT))
    repeated = left.join(present, key, "left").selectExpr(
        *left.columns, f"explode_outer({_PRESENT}) as {_SLICE}"
    )
    sliced = right.withColumn(_SLICE, F.expr(slice_of))
    return repeated.join(sliced, [key, _SLICE], "left").drop(_SLICE)
