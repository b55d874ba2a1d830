"""Mixing sources to target weights by capped water-filling.

Every source wants its share, by weight, of the words to sample. A source that would exceed its
maximum of epochs is clamped there, and what it leaves is shared again by weight. Sorted by
maximum over weight, the clamped sources come first, so running totals give the result at once.
Documents are then taken in whole repetitions, plus one fractional repetition that takes
documents in a seeded order until the words of their source are reached.

All running totals are computed over ranges of a global order, so neither a hot source nor a
long list of sources ends up in one task.

Nulls and edge cases: a null text has no words, so nothing of it is taken. Null sources form one
source, the last. Sources without words get no target. Rows that share an id are separate
documents; rows that are equal in id, source and size are interchangeable. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carebase.llm.text import WHITE, pieces
from carebase.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, Column]) -> DataFrame:
    """``df`` with, for each name, the sum of its column over all rows that come earlier.

    Rows are dealt out by ranges of ``order``; only one sum per range meets in one place.
    """
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_range").agg(*(F.sum(c).alias(f"_{n}") for n, c in totals.items()))
    starts = sums.select(
        "_range", *(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in totals)
    )
    within = Window.partitionBy("_range").orderBy(*order)
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    return dealt.join(starts, "_range").select(
        *df.columns,
        *(
            (F.col(f"_{n}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(n)
            for n, c in totals.items()
        ),
    )


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """(source, source_size, source_start, target): the words to take from each source.

    ``weights`` repeat over the sources in code point order. ``source_start`` is the number of
    words of all earlier sources.
    """
    by_source = [F.col("source").asc_nulls_last()]
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(
        totals, by_source, {"rank": F.lit(1), "source_start": F.col("source_size")}
    )
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int"))
    caps = ranked.select(
        "source",
        "source_size",
        "source_start",
        weight.cast("double").alias("weight"),
        (F.col("source_size") * float(max_epochs)).alias("cap"),
    )
    caps = written(caps.withColumn("fill", F.col("cap") / F.col("weight")), "caps")
    sums = caps.agg(
        (F.sum("source_size") * float(share)).alias("words"), F.sum("weight").alias("weight")
    )
    order = [F.col("fill"), F.col("source").asc_nulls_last()]
    filled = running_totals(caps, order, {"full": F.col("cap"), "used": F.col("weight")})
    level = (sums.select("words").scalar() - F.col("full")) / (
        sums.select("weight").scalar() - F.col("used")
    )
    levels = written(filled.withColumn("level", level), "levels")
    # The first source below its cap sets the level of all others below theirs.
    open_level = levels.where("fill > level").agg(F.min_by("level", "fill")).scalar()
    target = F.when(F.col("fill") <= F.col("level"), F.col("cap"))
    return levels.select(
        "source",
        "source_size",
        "source_start",
        target.otherwise(F.col("weight") * open_level).alias("target"),
    )


def take_words(sizes: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """``sizes`` with source_size, target and taken, the words to take of each document."""
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = [F.col("source").asc_nulls_last(), F.col("hash"), F.col("doc_id"), F.col("size")]
    placed = running_totals(sizes.withColumn("hash", hashed), order, {"before": F.col("size")})
    named = targets.withColumnRenamed("source", "_source")
    joined = placed.join(named, placed["source"].eqNullSafe(named["_source"]))
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    extra = F.floor(F.col("target") - whole * F.col("source_size"))
    left = extra - (F.col("before") - F.col("source_start"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (whole * F.col("size") + part).cast("long").alias("taken"),
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the words of each document between white space, stored."""
    size = F.size(pieces(F.col("text"), WHITE)).cast("long")
    return written(docs.select("doc_id", "source", size.alias("size")), "sizes")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every document."""
    sizes = document_sizes(docs)
    return take_words(sizes, source_targets(sizes, weights, share, max_epochs), seed)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of which the mix takes words, with one more column, ``taken``.

    Rows equal in id, source and size get the words of one of them.
    """
    taken = mix(docs, **options).where("taken > 0")
    chosen = taken.groupBy(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")
    ).agg(F.max("taken").alias("taken"))
    size = F.size(pieces(docs["text"], WHITE)).cast("long")
    same = (
        docs["doc_id"].eqNullSafe(chosen["_id"])
        & docs["source"].eqNullSafe(chosen["_source"])
        & (size == chosen["_size"])
    )
    rest = [docs[c] for c in docs.columns if c != "taken"]
    return docs.join(chosen, same).select(*rest, chosen["taken"])


def op4_source_mix(spark, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source,
                  cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS bigint) AS size
           FROM documents),
s AS (SELECT source, cast(sum(size) AS bigint) AS source_size,
             [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
      FROM d GROUP BY source),
f AS (SELECT *, 2.0::double * source_size AS cap, 2.0::double * source_size / weight AS fill FROM s),
l AS (SELECT *, (1.5::double * (sum(source_size) OVER ())
                 - coalesce(sum(cap) OVER (ORDER BY fill, source NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / ((sum(weight) OVER ())
                 - coalesce(sum(weight) OVER (ORDER BY fill, source NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM f),
t AS (SELECT source, source_size,
             CASE WHEN fill <= level THEN cap
                  ELSE weight * (SELECT arg_min(level, fill) FROM l WHERE fill > level) END AS target
      FROM l),
b AS (SELECT d.*, source_size, target, coalesce(floor(target / nullif(source_size, 0)), 0) AS whole,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || doc_id), doc_id, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       cast(whole * size + greatest(0, least(size, floor(target - whole * source_size) - before))
            AS bigint) AS taken
FROM b
"""
