"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, grouping.

1. One pass reads each text, hashes its word shingles and makes a SuperMinHash signature: every
   shingle ranks the registers by a random permutation of its own, and the rounds stop as soon as
   no later rank can lower a register. Documents with equal sets become one class.
2. Signatures of classes are cut into bands; classes that share a band meet in a bucket.
3. In a small bucket all pairs are candidates; in a large one, each member and a pivot, the most
   central member. Candidates that agree in too few registers are skipped, all others are
   confirmed on the full sets of their texts. So a large bucket of copies costs as many pairs as
   it has members.
4. Members of a large bucket that are not in its main group after that are compared with all
   others of the bucket, block by block: by signatures, then, of those with a plausible partner in
   the block, on full sets. No pair that shares a bucket and is not connected by then goes
   uncompared.
5. Confirmed links are grouped by hooking each class to its smallest neighbour and jumping to the
   label of the label until nothing changes. Links found later are grouped between labels. Copies
   are no links: each document takes the label of its class.

Between steps, tables are stored in the shared folder. The driver sees counts only.

Nulls and edge cases: null, empty and white texts have an empty set and are linked with nothing.
Rows that share an id are one document in links, with a row each. Rows without an id are linked
with nothing: component_id is null and kept is true. Other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carebase.llm.text import hash_bitmap, in_bitmap
from carebase.session import written

# Executors get the functions of this module by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 3
PERCENT = 85
# A pair at 85 % shares no band with probability (1 - 0.85 ** 4) ** 24, below one in ten million.
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
# Of 96 registers, a pair at 85 % agrees in 82 on average, and in fewer than 58 with probability
# below one in a billion.
AGREEING = 58
# Up to this number of members, all pairs of a bucket are candidates.
SMALL = 24
# The members of a large bucket that one task holds, from either side.
BLOCK = 384
COLUMNS = 4096
# About so many hashes of a block are sorted at a time.
HASHES = 1 << 19
WINDOW_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


class WordHasher:
    """Hashes of the words between white space, A-Z lower-cased, from differences of prefix sums."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE, 1), _powers(_INVERSE, 1)

    def __call__(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode().lower(), dtype=np.uint8)
        found = []
        start = 0
        while start < len(data):
            end = min(start + WINDOW_BYTES, len(data))
            while end < len(data) and not _SPACE[data[end]]:  # a word isn't cut
                end += 1
            found.append(self._window(data[start:end]))
            start = end
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def _window(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
        blank = np.concatenate(([True], _SPACE[data], [True]))
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: n - 1], out=sums[1:])
        words = (sums[ends] - sums[starts]) * self.down[starts]
        return mixed(words + (ends - starts).astype(np.uint64) * _GOLDEN)


def shingle_set(text: str | None, hasher: WordHasher, size: int = WORDS) -> np.ndarray:
    """The sorted hashes of the distinct shingles; fewer words make one shingle, none make none."""
    words = hasher(text or "")
    if not len(words):
        return words
    size = min(size, len(words))
    shingles = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        shingles = mixed(shingles * _GOLDEN + words[k : len(words) - size + 1 + k])
    return np.unique(shingles)


def super_minhash(elements: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The lowest ranks per register, as numbers of 64 bits that are equal if the ranks are.

    In round j every element gives one register, taken without repetition, a value in [j, j + 1).
    """
    lowest = np.full(registers, np.inf)
    picks: list[np.ndarray] = []
    few = len(elements) <= registers
    places = np.tile(np.arange(registers), (len(elements), 1)) if few else None
    rows = np.arange(len(elements))
    for j in range(registers):
        random = mixed(elements + np.uint64((2 * j + 1) * int(_GOLDEN) % 2**64))
        pick = j + ((random >> np.uint64(32)) % np.uint64(registers - j)).astype(np.int64)
        value = j + (mixed(random) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        if few:
            register = places[rows, pick]
            places[rows, pick] = places[:, j]
        else:
            # Where the swaps of earlier rounds have moved the register at this place from.
            register = pick
            for i in range(j - 1, -1, -1):
                register = np.where(picks[i] == register, i, register)
            picks.append(pick)
        np.minimum.at(lowest, register, value)
        if lowest.max() < j + 1:
            break
    return lowest.view(np.uint64)


_SKETCH = "doc_id long, n_shingles long, low long, high long, bands array<long>, signs binary"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    tags = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        rows = []
        for text in batch["text"]:
            shingles = shingle_set(text.as_py(), hasher)
            if not len(shingles):
                rows.append((0, 0, 0, None, None))
                continue
            low, high = mixed(shingles).sum(), mixed(shingles ^ _GOLDEN).sum()
            ranks = mixed(super_minhash(shingles))
            bands = tags
            for column in ranks.reshape(BANDS, ROWS).T:
                bands = mixed(bands * _GOLDEN + column)
            signs = (ranks & np.uint64(255)).astype(np.uint8).tobytes()
            hashes = int(low.view(np.int64)), int(high.view(np.int64))
            rows.append((len(shingles), *hashes, bands.view(np.int64), signs))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        arrays = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
        names = ["doc_id", "n_shingles", "low", "high", "bands", "signs"]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], names=names)


def _confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of texts whose full sets are alike enough."""
    hasher = WordHasher()
    last, ours = None, np.zeros(0, np.uint64)
    for batch in batches:
        keep = []
        for a, left, right in zip(batch["a"], batch["a_text"], batch["b_text"], strict=True):
            if a != last:
                last, ours = a, shingle_set(left, hasher)
            theirs = shingle_set(right, hasher)
            both = len(np.intersect1d(ours, theirs, assume_unique=True))
            union = len(ours) + len(theirs) - both
            keep.append(both > 0 and 100 * both >= PERCENT * union)
        yield batch.loc[keep, ["a", "b"]]


def _hash_ranges(sets: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The sorted sets cut at the same hashes, into parts of about ``HASHES`` in all."""
    parts = sum(map(len, sets)) // HASHES + 1
    cuts = np.array([2**64 * k // parts for k in range(1, parts)], np.uint64)
    places = [[0, *np.searchsorted(x, cuts), len(x)] for x in sets]
    for k in range(parts):
        yield [x[at[k] : at[k + 1]] for x, at in zip(sets, places, strict=True)]


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each sorted set on the left has in common with each on the right."""
    both = np.zeros((len(left), len(right)), np.float32)
    for sets in _hash_ranges(left + right) if left and right else ():
        values = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])
        _, column, times = np.unique(values, return_inverse=True, return_counts=True)
        often = times > 1
        place = np.cumsum(often) - 1
        chosen = often[column]
        owner, column = owner[chosen], place[column[chosen]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for first in range(0, int(often.sum()), COLUMNS):
            lo, hi = np.searchsorted(column, (first, first + COLUMNS))
            has = np.zeros((len(sets), COLUMNS), np.float32)
            has[owner[lo:hi], column[lo:hi] - first] = 1
            both += has[: len(left)] @ has[len(left) :].T
    return both.astype(np.int64)


_DEALT = "key long, i int, j int, id long, label long, outside boolean"


def _block_candidates(block: pd.DataFrame) -> pd.DataFrame:
    """The rows of a block that sizes and signatures leave a partner with another label."""
    outside = block["outside"].to_numpy()
    n, label = block["n"].to_numpy(), block["label"].to_numpy()
    signs = np.frombuffer(b"".join(block["signs"]), np.uint8).reshape(len(block), REGISTERS)
    agreeing = np.zeros((outside.sum(), (~outside).sum()), np.uint8)
    for ours, theirs in zip(signs[outside].T, signs[~outside].T, strict=True):
        agreeing += ours[:, None] == theirs[None, :]
    smaller = np.minimum(n[outside][:, None], n[~outside][None, :])
    larger = np.maximum(n[outside][:, None], n[~outside][None, :])
    found = (agreeing >= AGREEING) & (100 * smaller >= PERCENT * larger)
    found &= label[outside][:, None] != label[~outside][None, :]
    keep = np.zeros(len(block), dtype=bool)
    keep[outside], keep[~outside] = found.any(axis=1), found.any(axis=0)
    return block.loc[keep, ["key", "i", "j", "id", "label", "outside"]]


def _block_links(block: pd.DataFrame) -> pd.DataFrame:
    """Links between outsiders and members of one bucket, which differ in their label."""
    hasher = WordHasher()
    sides = [block[block["outside"]], block[~block["outside"]]]
    sets = [[shingle_set(t, hasher) for t in side["text"]] for side in sides]
    both = shared_counts(*sets)
    sizes = [np.array([len(x) for x in side], dtype=np.int64) for side in sets]
    union = sizes[0][:, None] + sizes[1][None, :] - both
    labels = [side["label"].to_numpy() for side in sides]
    found = (both > 0) & (100 * both >= PERCENT * union) & (labels[0][:, None] != labels[1][None, :])
    i, j = np.nonzero(found)
    ids = [side["id"].to_numpy() for side in sides]
    return pd.DataFrame({"a": np.minimum(ids[0][i], ids[1][j]), "b": np.maximum(ids[0][i], ids[1][j])})


def sketch(docs: DataFrame) -> DataFrame:
    """One row per document: its number of shingles, a hash of its set, bands and register signs."""
    return written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sketches, _SKETCH), "sketches")


def _agreement() -> Column:
    """How many of the registers of two classes have the same sign."""
    places = F.sequence(F.lit(1), F.lit(2 * REGISTERS), F.lit(2))
    return F.aggregate(
        places,
        F.lit(0),
        lambda n, i: n
        + (F.substring("a_hex", i, F.lit(2)) == F.substring("b_hex", i, F.lit(2))).cast("int"),
    )


def _joined(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` with the columns of both of their classes, named a_ and b_."""
    for side in ("a", "b"):
        named = table.select(F.col("id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns))
        pairs = pairs.join(named, side)
    return pairs


def _plausible(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """Pairs that their sizes and signatures do not rule out."""
    sized = _joined(pairs, signs.withColumn("hex", F.hex("signs")), "n", "hex")
    smaller, larger = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return sized.where(100 * smaller >= PERCENT * larger).where(_agreement() >= AGREEING).select("a", "b")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id that each linked id reaches through the links (a, b)."""
    # Both directions from one reading, or the links would be made twice.
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(links.select(F.inline(ways)).distinct(), "links")
    labels = written(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("label")),
        "labels",
    )
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), "label"), "b")
        offered = seen.groupBy(F.col("a").alias("id")).agg(F.min("label").alias("offer"))
        hooked = labels.join(offered, "id").select(
            "id", F.col("label").alias("old"), F.least("label", "offer").alias("label")
        )
        roots = hooked.select(F.col("id").alias("label"), F.col("label").alias("root"))
        labels = written(
            hooked.join(roots, "label").select("id", "old", F.col("root").alias("label")), "labels"
        )
        if labels.where("old <> label").isEmpty():
            return labels.select("id", "label")
        labels = labels.select("id", "label")


def candidate_pairs(members: DataFrame) -> DataFrame:
    """(a, b): all pairs of small buckets, and each member with the pivot of large ones.

    ``members`` has key, id, weight and the number of members of the bucket.
    """
    few = members.where(F.col("members") <= SMALL)
    other = few.select("key", F.col("id").alias("id2"))
    among = few.join(other, "key").where("id < id2").select(F.col("id").alias("a"), F.col("id2").alias("b"))
    many = members.where(F.col("members") > SMALL)
    rank = F.struct("weight", (-F.col("id")).alias("early"), "id")
    pivots = many.groupBy("key").agg(F.max(rank)["id"].alias("pivot"))
    against = many.join(pivots, "key").where("id <> pivot").select(*_ordered("id", "pivot"))
    return among.union(against).distinct()


def outsider_links(members: DataFrame, labels: DataFrame, signs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links in large buckets from members that are not in the bucket's main group."""
    many = members.where(F.col("members") > SMALL).select("key", "id", "members")
    labelled = many.join(labels, "id", "left").select(
        "key", "id", "members", F.coalesce("label", "id").alias("label")
    )
    labelled = written(labelled, "labelled")
    groups = labelled.groupBy("key", "label").agg(F.count("*").alias("n"))
    mains = groups.groupBy("key").agg(F.max(F.struct("n", "label")).alias("main"))
    sized = (
        labelled.join(mains, "key")
        .where(F.col("main.n") < F.col("members"))
        .withColumn("out", F.col("label") != F.col("main.label"))
        .join(signs, "id")
    )
    n_all, n_out = F.col("members"), F.col("members") - F.col("main.n")
    all_blocks = F.ceil(n_all / BLOCK).cast("int")
    out_blocks = F.ceil(n_out / BLOCK).cast("int")

    def dealt(outside: bool, own: Column, others: Column) -> DataFrame:
        rows = sized.where("out") if outside else sized
        mine = F.pmod(F.xxhash64("id"), own).cast("int")
        every = F.explode(F.sequence(F.lit(0), others - 1))
        names = ("i", "j") if outside else ("j", "i")
        return rows.select(
            "key", "id", "label", F.lit(outside).alias("outside"), "n", "signs",
            mine.alias(names[0]), every.alias(names[1]),
        ).select("key", "i", "j", "id", "label", "outside", "n", "signs")

    blocks = dealt(True, out_blocks, all_blocks).union(dealt(False, all_blocks, out_blocks))
    # Texts are dealt only where signatures leave something to confirm.
    blocks = blocks.groupBy("key", "i", "j").applyInPandas(_block_candidates, _DEALT).distinct()
    found = blocks.join(texts, "id").groupBy("key", "i", "j").applyInPandas(_block_links, "a long, b long")
    return written(found.distinct(), "outsiders")


def class_homes(sketches: DataFrame) -> DataFrame:
    """(doc_id, first): the smallest id of each class that a document with words and id is in."""
    nonempty = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = nonempty.groupBy("low", "high", "n_shingles").agg(F.min("doc_id").alias("first"))
    return written(nonempty.join(classes, ["low", "high", "n_shingles"]).select("doc_id", "first"), "homes")


def near_duplicate_labels(sketches: DataFrame, homes: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, label): the smallest class that each linked class reaches; classes go by their first id.

    Classes that share a document, by rows with one id and other texts, are linked.
    """
    first = homes.where("doc_id = first").select("doc_id")
    chosen = sketches.where("n_shingles > 0").join(first, "doc_id", "left_semi")
    # Dealt by bucket once, for both the distinct rows and their number.
    banded = chosen.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key")).repartition("key")
    placed = banded.distinct().withColumn("members", F.count("*").over(Window.partitionBy("key")))
    weight = F.sum("members").over(Window.partitionBy("id")).alias("weight")
    members = written(placed.where("members > 1").select("id", "key", "members", weight), "members")

    wanted = members.select(F.col("id").alias("doc_id"))
    texts = docs.select("doc_id", "text").withColumn("bitmap", hash_bitmap(wanted, "doc_id"))
    texts = texts.where(in_bitmap(F.col("bitmap"), F.col("doc_id"))).drop("bitmap")
    texts = written(
        texts.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "text"), "texts"
    )
    signs = chosen.join(wanted, "doc_id", "left_semi").select(
        F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "signs"
    )
    signs = written(signs, "signs")
    plausible = written(_plausible(candidate_pairs(members), signs), "plausible")
    texted = _joined(plausible, texts, "text").select("a", "b", "a_text", "b_text")
    links = texted.mapInPandas(_confirmed, "a long, b long")
    least = F.min("first").over(Window.partitionBy("doc_id"))
    shared = homes.select(least.alias("a"), F.col("first").alias("b")).where("a <> b")
    labels = components(links.union(shared))
    if members.where(F.col("members") > SMALL).isEmpty():
        return labels
    outside = outsider_links(members, labels, signs, texts)
    if outside.isEmpty():
        return labels
    ends = outside.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    named = ends.join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("top"))
    tops = components(_joined(outside, named, "top").select(*_ordered("a_top", "b_top")))
    top = tops.select(F.col("id").alias("label"), F.col("label").alias("top"))
    joined = labels.join(top, "label", "left").select("id", F.coalesce("top", "label").alias("label"))
    # A class that only such a link reaches is its own label in it.
    return joined.union(tops).distinct()


def group_near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    sketches = sketch(docs)
    homes = class_homes(sketches)
    labels = near_duplicate_labels(sketches, homes, docs)
    # Copies take the label of the first document of their class.
    homed = homes.join(labels, F.col("first") == F.col("id"), "left")
    labels = homed.groupBy("doc_id").agg(F.min(F.coalesce("label", "first")).alias("label"))
    joined = sketches.select("doc_id", "n_shingles").join(labels, "doc_id", "left")
    component = F.coalesce("label", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents, with all columns, of which the smallest id of each group stays."""
    gone = group_near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone.distinct(), docs["doc_id"] == F.col("_gone"), "left_anti")


def op9_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return group_near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
