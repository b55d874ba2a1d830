"""Benchmark passages in documents, found through a positional inverted index.

Two passes over the documents. The first counts in how many documents each benchmark term
occurs. The second stores postings of the rarest term of every window only, each with the
words around it; the lists of the other terms, adjusted by their offsets, are these words.
So common words cost no postings, and a hot document or term spreads over all tasks.

Nulls and edge cases: a null or empty text has no words, so it has no hits and is no item.
Equal windows of several items are searched once and count for each item. Rows that share an
id are separate documents and give a row each; items that share an id count once. Items with
a null id mark hits, but are left out of the item list. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carebase.llm.text import hash_bitmap, in_bitmap, words
from carebase.session import written

WINDOW = 10


@dataclass(frozen=True)
class PositionalIndex:
    """``postings``: per document its key and number of words, and one row for each place of a
    probe term with the words around it, or one row without a place. ``probes``: the rarest
    term of each window and its offset. ``window_items``: the items of each window."""

    postings: DataFrame
    probes: DataFrame
    window_items: DataFrame


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, window_key, window): all runs of ``size`` words, or all words of a shorter item."""
    split = items.select(F.col("item_id").cast("string").alias("item"), words("text").alias("w"))
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0))))
    return (
        split.where(F.size("w") > 0)
        .select("item", "w", start.alias("start"))
        .select("item", F.slice("w", F.col("start") + 1, F.lit(size)).alias("window"))
        .select("item", F.md5(F.array_join("window", " ")).alias("window_key"), "window")
        .distinct()
    )


def term_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, documents): in how many documents each of ``terms`` occurs."""
    listed = docs.select(words("text").alias("w"), hash_bitmap(terms, "term").alias("bitmap"))
    known = F.array_distinct(F.filter("w", lambda t: in_bitmap(F.col("bitmap"), t)))
    counts = listed.select(F.explode(known).alias("term")).groupBy("term")
    return counts.agg(F.count("*").alias("documents")).join(terms, "term", "left_semi")


def probe_terms(windows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """The rarest term of each window. Windows with a term that never occurs are left out."""
    terms = windows.select("window_key", "window", F.posexplode("window").alias("offset", "term"))
    rank = F.struct(F.coalesce("documents", F.lit(0)).alias("documents"), "term", "offset")
    rarest = terms.join(frequencies, "term", "left").groupBy("window_key", "window").agg(
        F.min(rank).alias("rarest")
    )
    return rarest.where("rarest.documents > 0").select(
        "window_key", "window", "rarest.term", "rarest.offset"
    )


def build_index(
    docs: DataFrame,
    items: DataFrame,
    key: Column | None = None,
    size: int = WINDOW,
    slack: int = 0,
) -> PositionalIndex:
    """Stores the postings that a search for ``items`` needs.

    ``key`` is kept with each document, ``doc_id`` by default. ``slack`` is the number of words
    that a proximity search may look beyond a window.
    """
    windows = written(item_windows(items, size), "windows")
    distinct = windows.select("window_key", "window").distinct()
    terms = distinct.select(F.explode("window").alias("term")).distinct()
    probes = written(probe_terms(distinct, term_frequencies(docs, terms)), "probes")

    reach = size - 1 + slack
    listed = docs.select(
        F.monotonically_increasing_id().alias("row"),
        (F.col("doc_id") if key is None else key).alias("key"),
        words("text").alias("w"),
        hash_bitmap(probes, "term").alias("bitmap"),
    )
    index = F.sequence(F.lit(0), F.size("w") - 1)
    found = F.filter(index, lambda i: in_bitmap(F.col("bitmap"), F.get("w", i)))
    places = F.when(F.size("w") > 0, found)
    left = F.greatest(F.col("at") - reach, F.lit(0))
    postings = (
        listed.select("row", "key", "w", F.explode_outer(places).alias("at"))
        .select(
            "row",
            "key",
            F.size("w").cast("long").alias("n_words"),
            "at",
            F.get("w", F.col("at")).alias("term"),
            left.alias("left"),
            F.slice("w", left + 1, F.col("at") - left + 1 + reach).alias("around"),
        )
    )
    return PositionalIndex(
        written(postings, "postings"), probes, windows.select("window_key", "item")
    )


def _candidates(index: PositionalIndex) -> DataFrame:
    return index.postings.where("term IS NOT NULL").join(index.probes, "term")


def phrase_matches(index: PositionalIndex) -> DataFrame:
    """(row, window_key, start, stop): every occurrence of every window, in words."""
    start = F.col("at") - F.col("offset")
    n = F.size("window")
    aligned = F.slice("around", F.greatest(start - F.col("left"), F.lit(0)) + 1, n)
    return (
        _candidates(index)
        .where((start >= 0) & (aligned == F.col("window")))
        .select("row", "window_key", start.alias("start"), (start + n).alias("stop"))
        .distinct()
    )


def proximity_matches(index: PositionalIndex, slack: int = 0) -> DataFrame:
    """(row, window_key, at): places of probe terms that have all terms of the window, in any
    order, within ``slack`` words more than the window has on either side."""
    reach = F.size("window") - 1 + slack
    skip = F.greatest(F.col("at") - F.col("left") - reach, F.lit(0))
    near = F.slice("around", skip + 1, F.col("at") - F.col("left") - skip + 1 + reach)
    missing = F.size(F.array_except("window", near))
    return _candidates(index).where(missing == 0).select("row", "window_key", "at").distinct()


def contamination(index: PositionalIndex) -> DataFrame:
    """(key, n_words, n_hit, items): per document the words inside occurrences of windows, and
    the sorted ids of the items that these windows belong to."""
    hits = written(phrase_matches(index), "phrases")
    before = Window.partitionBy("row").orderBy("start", "stop")
    seen = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("stop") - F.greatest(F.col("start"), F.coalesce("seen", F.lit(0)))
    spans = hits.select("row", "start", "stop").distinct().withColumn("seen", seen)
    covered = spans.groupBy("row").agg(
        F.sum(F.greatest(fresh, F.lit(0))).cast("long").alias("n_hit")
    )
    named = (
        hits.select("row", "window_key")
        .distinct()
        .join(index.window_items, "window_key")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    documents = index.postings.groupBy("row").agg(
        F.first("key").alias("key"), F.first("n_words").alias("n_words")
    )
    return documents.join(covered, "row", "left").join(named, "row", "left").select(
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with all their columns.

    Whether a document stays depends on its text alone, so texts are compared by their hash.
    """
    digest = F.md5(docs["text"])
    found = contamination(build_index(docs, items, key=F.md5("text"))).where("n_hit > 0")
    bad = found.select(F.col("key").alias("_bad_text")).distinct()
    return docs.join(bad, digest == F.col("_bad_text"), "left_anti")


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(build_index(docs, items))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT cast(item_id AS varchar) AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, list_slice(w, s + 1, s + 10) AS win
        FROM (SELECT item, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM i
              WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(win) AS n FROM win),
gram AS (SELECT doc_id, n, s, list_slice(w, s + 1, s + n) AS win
         FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s
               FROM d JOIN size ON len(w) >= n)),
hit AS (SELECT doc_id, item, s, n FROM gram JOIN win USING (win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(n_hit, 0) AS bigint) AS n_hit,
       cast(coalesce(n_items, 0) AS bigint) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
