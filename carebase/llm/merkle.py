"""Merkle fingerprints of documents: sentences, paragraphs, sections, root.

Equal texts have equal roots. A fingerprint also lists its leaves in their tree, so two of them
tell which branches differ, and how alike the texts are, without the texts.

A fingerprint reads ``root:section/section``; a section is ``paragraph;paragraph`` and a paragraph
the hashes of its leaves, eight digits each. Leaves are sentences, in pieces of at most eight words,
together with the white space behind them, so that every edit shows in the root.

For comparing each document with its successor, documents are dealt out by ranges of their ids, and
the first of each range also goes to the range before. So each text is shuffled once, and no task
sees more than its range.

Nulls and edge cases: a null text is an empty one, whose tree has a root only. Among rows that share
an id the order of their texts decides. Rows without an id have no place in the order; each
is its own successor. Other columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Executors get the functions of this module by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS_PER_LEAF = 8
LEAF_DIGITS = 8
# A sentence, or as many words as fit into a leaf, with the white space that follows.
_LEAF = re.compile(rf"\s+|(?:\S*[^\s.!?]\s+){{0,{WORDS_PER_LEAF - 1}}}\S+\s*")
_PARAGRAPH = re.compile(r"[^\n]*\n?")
_SECTION = re.compile(r"(?<=\n)(?=[ \t\r]*\n)")


def _hash(data: bytes) -> bytes:
    return blake2b(data, digest_size=16).digest()


def _paragraphs(section: str) -> list[str]:
    return [p for p in _PARAGRAPH.findall(section) if p]


def fingerprint(text: str) -> str:
    roots, listed = [], []
    for section in _SECTION.split(text) if text else ():
        tops, leaves = [], []
        for paragraph in _paragraphs(section):
            hashes = [_hash(leaf.encode()) for leaf in _LEAF.findall(paragraph)]
            tops.append(_hash(b"".join(hashes)))
            leaves.append("".join(h.hex()[:LEAF_DIGITS] for h in hashes))
        roots.append(_hash(b"".join(tops)))
        listed.append(";".join(leaves))
    return f"{_hash(b''.join(roots)).hex()}:{'/'.join(listed)}"


def _leaves(mark: str) -> Counter[str]:
    flat = mark.partition(":")[2].replace("/", "").replace(";", "")
    return Counter(flat[i : i + LEAF_DIGITS] for i in range(0, len(flat), LEAF_DIGITS))


def likeness(a: str, b: str) -> float:
    """Twice the leaves that both have, over all leaves of both; 1 for equal roots only."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return 1.0
    ours, theirs = _leaves(a), _leaves(b)
    total = sum(ours.values()) + sum(theirs.values())
    shared = sum((ours & theirs).values())
    return min(2.0 * shared / total, 1.0 - 1e-9) if total else 0.0


def differing_branches(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of every paragraph of ``a`` that differs from that of ``b``."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return []
    ours, theirs = ([s.split(";") for s in m.partition(":")[2].split("/")] for m in (a, b))
    found = []
    for i, section in enumerate(ours):
        other = theirs[i] if i < len(theirs) else []
        found += [(i, j) for j, p in enumerate(section) if j >= len(other) or other[j] != p]
    return found


def edited(text: str, following: str) -> str:
    """The last half of ``text``, rounded down, replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order; a row is finished as soon as its successor is known."""
    before: tuple | None = None
    for batch in batches:
        done = []
        for row in batch.itertuples(index=False):
            text = row.text
            current = (row.bucket, row.doc_id, row.has_id, row.is_copy, text, fingerprint(text))
            if not row.has_id:
                done.append(_row(current, current))
                continue
            if before is not None and not before[3]:
                done.append(_row(before, current))
            # Of several copies that close a range, the first is the successor.
            before = current
        if done:
            names = [c.split()[0] for c in _RESULT.split(", ")]
            columns = dict(zip(names, zip(*done, strict=True), strict=True))
            columns["doc_id"] = pd.array(columns["doc_id"], dtype="Int64")
            yield pd.DataFrame(columns)


def _row(this: tuple, following: tuple) -> tuple:
    text, mark = this[4], this[5]
    changed = edited(text, following[4])
    changed_mark = fingerprint(changed)
    return (
        this[1] if this[2] else None,
        len(text),
        sha256(changed.encode()).hexdigest(),
        mark,
        changed_mark,
        likeness(mark, changed_mark),
        likeness(mark, following[5]),
    )


def _range_of(bounds: Column, value: Column) -> Column:
    """How many of the rising ``bounds`` are above ``value``, by binary search."""
    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = ((state["low"] + state["high"] - (state["low"] + state["high"]) % 2) / 2).cast("int")
        right = F.get(bounds, middle) <= value
        searching = state["low"] < state["high"]
        return F.struct(
            F.when(searching & right, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(searching & ~right, middle).otherwise(state["high"]).alias("high"),
        )

    found = F.aggregate(F.sequence(F.lit(1), F.lit(32)), start, halve)
    return F.size(bounds) - found["low"]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text, and how alike both are, and how alike
    the next document is, in falling order of ids; after the last comes the first."""
    spark = docs.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    ids = docs.select("doc_id").where("doc_id IS NOT NULL")
    bounds = ids.agg(
        F.array_sort(F.array_distinct(F.percentile_approx("doc_id", shares, 10 * ranges))).alias("b")
    ).scalar()
    known = F.coalesce(bounds, F.array().cast("array<long>"))
    heads = (
        ids.withColumn("bounds", known)
        .groupBy(_range_of(F.col("bounds"), F.col("doc_id")).alias("bucket"))
        .agg(F.max("doc_id").alias("head"))
    )
    order = Window.orderBy("bucket")
    last = F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # One row per range.
    heads = heads.select("head", F.coalesce(F.lag("bucket").over(order), last).alias("before"))
    text = F.coalesce("text", F.lit(""))
    placed = (
        docs.select("doc_id", text.alias("text"), known.alias("bounds"))
        .withColumn(
            "bucket",
            F.when(F.col("doc_id").isNotNull(), _range_of(F.col("bounds"), F.col("doc_id"))).otherwise(
                F.pmod(F.xxhash64("text"), F.lit(ranges)).cast("int")
            ),
        )
        .join(F.broadcast(heads), F.col("doc_id") == F.col("head"), "left")
    )
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("is_copy"))
    copy = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("is_copy"))
    sent = placed.select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("has_id"),
        "text",
        F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("to"),
    ).select("to.*", "doc_id", "has_id", "text")
    return (
        sent.repartitionById(ranges, F.col("bucket"))
        .sortWithinPartitions("bucket", F.desc("has_id"), "is_copy", F.desc("doc_id"), "text")
        .mapInPandas(_compare, _RESULT)
    )


def op8_merkle(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
