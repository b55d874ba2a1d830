"""Prefix trie of conversations by vertical bitmaps.

A node of the trie is a distinct sequence of first turns; its members are the conversations that
start with it. Conversations are cut into shards of consecutive ids, of up to ``SHARD_CONVERSATIONS``
conversations and ``SHARD_TURNS`` turns. A shard indexes every (position, turn) to the bitset of its
conversations that have the turn there. Depth first, the bitset of a node is intersected with the
postings of the next position: that yields its children, their population counts, and the list of
members that end there. A conversation longer than a whole shard is a shard of its own and streams
through, since its nodes form a single chain.

Nodes are named by a 128-bit hash of their sequence, so the shards' parts of one node meet in a
grouping that combines before it shuffles: however many conversations share a node, each shard sends
one row for it. What counts every node of a subtree once (leaves, saved tokens) is credited to the
shard of the node's smallest member, summed up within the shards in reverse depth-first order, and
then added over the shards. Lists of ending members come in order of the shards and are hashed as
a stream. Memory of a task is bounded by one shard; texts never leave the scan.

Nulls and edge cases: rows without a conversation id belong to none and are left out. Turns come in
their order, null first; turns of equal order come by the hash of their fields, and repeated rows
are turns of their own. Null and empty fields are the same. Conversations without turns are members
of the root only. Long texts count by their code points and are hashed once. An empty table has no
conversations and no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Generator, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carebase.session import written

SHARD_CONVERSATIONS = 1024
SHARD_TURNS = 2**16
ROOT = bytes(16)
KEY, PARENT = ["k1", "k2"], ["p1", "p2"]

_LOCAL = pa.schema(
    [(name, pa.int64()) for name in ("shard", "pre", "depth", *KEY, *PARENT, "conv_id", "n", "n_chars")]
    + [("ends", pa.string())]
)
_LOCAL_DDL = (
    "shard long, pre long, depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n long, "
    "n_chars long, ends string"
)
_SUMS = pa.schema([(name, pa.int64()) for name in (*KEY, "n_leaves", "saved_tokens")])
_HASHES = pa.schema([(name, pa.int64()) for name in KEY] + [("ends_sha256", pa.string())])


def turns_of(
    df: DataFrame, conversation: str = "conv_id", order: str = "turn", fields: Sequence[str] = ("role", "text")
) -> DataFrame:
    """(conv_id, position, turn, n_chars): positions from 1, a hash of all fields, and the code
    points of the last field."""
    values = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in fields]
    sized = [part for v in values for part in (F.octet_length(v).cast("string"), F.lit(":"), v)]
    rows = df.where(F.col(f"`{conversation}`").isNotNull()).select(
        F.col(f"`{conversation}`").cast("long").alias("conv_id"),
        F.col(f"`{order}`").alias("order"),
        F.unhex(F.substring(F.sha2(F.concat(*sized), 256), 1, 32)).alias("turn"),
        F.length(values[-1]).cast("long").alias("n_chars"),
    )
    by = Window.partitionBy("conv_id").orderBy(F.col("order").asc_nulls_first(), "turn")
    return rows.withColumn("position", F.row_number().over(by).cast("long")).drop("order")


def _node_key(parent: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(parent + turn, digest_size=16).digest()


def _longs(key: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", key)


class Shard:
    """Consecutive conversations and the part of the trie that they make up."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.turns: list[list[bytes]] = []
        self.chars: list[list[int]] = []
        self.size = 0

    def start(self, conversation: int) -> None:
        self.ids.append(conversation)
        self.turns.append([])
        self.chars.append([])

    def add(self, turn: bytes, n_chars: int) -> None:
        self.turns[-1].append(turn)
        self.chars[-1].append(n_chars)
        self.size += 1

    def pop(self) -> Shard:
        """The last conversation, as a shard of its own."""
        last = Shard()
        last.ids, last.turns, last.chars = [self.ids.pop()], [self.turns.pop()], [self.chars.pop()]
        last.size = len(last.turns[0])
        self.size -= last.size
        return last

    def _members(self, bits: int) -> str | None:
        found = []
        while bits:
            low = bits & -bits
            found.append(str(self.ids[low.bit_length() - 1]))
            bits ^= low
        return ",".join(found) or None

    def nodes(self) -> Iterator[tuple]:
        """The shard's nodes in depth-first order, parents before children."""
        ids, turns, chars = self.ids, self.turns, self.chars
        postings: dict[tuple[int, bytes], int] = {}
        ends: dict[int, int] = {}
        for i, sequence in enumerate(turns):
            bit = 1 << i
            ends[len(sequence)] = ends.get(len(sequence), 0) | bit
            for slot in enumerate(sequence):
                postings[slot] = postings.get(slot, 0) | bit
        shard, pre, everyone = ids[0], 0, (1 << len(ids)) - 1
        todo = [(everyone, 0, ROOT, ROOT, 0)]
        while todo:
            bits, depth, key, parent, n_chars = todo.pop()
            smallest = ids[(bits & -bits).bit_length() - 1]
            here = bits & ends.get(depth, 0)
            row = (shard, pre, depth, *_longs(key), *_longs(parent), smallest, bits.bit_count(), n_chars)
            yield (*row, self._members(here))
            pre += 1
            rest = bits ^ here
            while rest:
                first = (rest & -rest).bit_length() - 1
                turn = turns[first][depth]
                child = rest & postings[depth, turn]
                rest ^= child
                todo.append((child, depth + 1, _node_key(key, turn), key, chars[first][depth]))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _chain(first: Shard, rows: Iterator[tuple]) -> Generator[tuple, None, tuple | None]:
    """Nodes of one long conversation, whose further turns come from ``rows``. Returns the first
    row of the next one, if there is one."""
    conversation = first.ids[0]

    def row(pre: int, key: bytes, parent: bytes, n_chars: int, ends: str | None) -> tuple:
        return (conversation, pre, pre, *_longs(key), *_longs(parent), conversation, 1, n_chars, ends)

    key, parent, pre, n_chars, following = ROOT, ROOT, 0, 0, None
    for turn, size in zip(first.turns[0], first.chars[0], strict=True):
        yield row(pre, key, parent, n_chars, None)
        key, parent, pre, n_chars = _node_key(key, turn), key, pre + 1, size
    for following in rows:
        if following[0] != conversation:
            break
        yield row(pre, key, parent, n_chars, None)
        key, parent, pre, n_chars = _node_key(key, following[2]), key, pre + 1, following[3]
        following = None
    yield row(pre, key, parent, n_chars, str(conversation))
    return following


def _local_rows(rows: Iterator[tuple], conversations: int, turns: int) -> Iterator[tuple]:
    shard = Shard()
    row = next(rows, None)
    while row is not None:
        conversation, _, turn, n_chars = row
        if not shard.ids or shard.ids[-1] != conversation:
            if len(shard.ids) >= conversations or shard.size >= turns:
                yield from shard.nodes()
                shard = Shard()
            shard.start(conversation)
        if turn is not None:
            shard.add(turn, n_chars)
        if len(shard.turns[-1]) < turns:
            row = next(rows, None)
            continue
        long = shard.pop()
        if shard.ids:
            yield from shard.nodes()
        shard = Shard()
        row = yield from _chain(long, rows)
    if shard.ids:
        yield from shard.nodes()


def local_tries(
    sequences: DataFrame, conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS
) -> DataFrame:
    """The nodes of every shard. ``sequences`` is (conv_id, position, turn, n_chars); a row without
    a turn only says that the conversation exists."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_local_rows(_columns(batches), conversations, turns), _LOCAL)

    ordered = sequences.select("conv_id", "position", "turn", "n_chars").repartitionByRange("conv_id")
    return ordered.sortWithinPartitions("conv_id", "position").mapInArrow(build, _LOCAL_DDL)


def _subtree_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over subtrees of the nodes of whole shards, which come in reverse depth-first order."""

    def sums() -> Iterator[tuple]:
        shard, below = None, {}
        for at, _, depth, k1, k2, leaves, saved in _columns(batches):
            if at != shard:
                shard, below = at, {}
            more_leaves, more_saved = below.pop(depth + 1, (0, 0))
            leaves, saved = leaves + more_leaves, saved + more_saved
            beside = below.get(depth, (0, 0))
            below[depth] = (beside[0] + leaves, beside[1] + saved)
            yield k1, k2, leaves, saved

    return _batches(sums(), _SUMS)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for all lists of a node, which come one after the other."""

    def hashes() -> Iterator[tuple]:
        node, state = None, None
        for k1, k2, _, ends in _columns(batches):
            if node == (k1, k2):
                state.update(b",")
            else:
                if node:
                    yield *node, state.hexdigest()
                node, state = (k1, k2), hashlib.sha256()
            state.update(ends.encode())
        if node:
            yield *node, state.hexdigest()

    return _batches(hashes(), _HASHES)


def prefix_trie(
    sequences: DataFrame, conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    A node is named by its smallest member and its depth.
    """
    local = written(local_tries(sequences, conversations, turns), "trie_local")
    nodes = local.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n").alias("n_convs"),
        *(F.min(name).alias(name) for name in ("depth", "n_chars", *PARENT)),
    )
    nodes = written(nodes, "trie_nodes")
    children = nodes.where("depth > 0").groupBy(*PARENT).agg(F.count("*").alias("n_children"))
    children = children.withColumnsRenamed(dict(zip(PARENT, KEY, strict=True)))
    nodes = nodes.join(children, KEY, "left").fillna(0, ["n_children"])

    credited = nodes.select(
        *KEY,
        F.col("conv_id").alias("owner"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"),
    )
    owned = F.col("conv_id") == F.col("owner")

    def credit(name: str) -> Column:
        return F.when(owned, F.col(name)).otherwise(0).alias(name)

    sums = (
        local.select("shard", "pre", "depth", *KEY, "conv_id")
        .join(credited, KEY)
        .select("shard", "pre", "depth", *KEY, credit("leaf"), credit("saved"))
        .repartition("shard")
        .sortWithinPartitions("shard", F.desc("pre"))
        .mapInArrow(_subtree_sums, "k1 long, k2 long, n_leaves long, saved_tokens long")
        .groupBy(*KEY)
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    ends = (
        local.where("ends IS NOT NULL")
        .select(*KEY, "shard", "ends")
        .repartition(*KEY)
        .sortWithinPartitions(*KEY, "shard")
        .mapInArrow(_hash_ends, "k1 long, k2 long, ends_sha256 string")
    )
    parents = nodes.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        nodes.join(sums, KEY)
        .join(ends, KEY, "left")
        .join(parents, PARENT, "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


BLOCK, MOST_SHARED = 100, 6


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Sequences in which every conversation starts with turns of the first one of its block.

    Conversation c takes the first h turns of c - c % ``BLOCK``, and its own ones after its first
    h; h is the CRC-32 of its number, modulo ``MOST_SHARED``.
    """
    turns = written(turns_of(conversations), "trie_turns")
    conv_id = F.col("conv_id")
    shared = F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED
    convs = turns.select("conv_id").distinct()
    heads = turns.where((conv_id % BLOCK == 0) & (F.col("position") < MOST_SHARED))
    heads = heads.withColumnRenamed("conv_id", "block")
    taken = convs.withColumn("block", conv_id - conv_id % BLOCK).join(heads, "block")
    columns = ["conv_id", "position", "turn", "n_chars"]
    return (
        turns.where(F.col("position") > shared)
        .select(*columns)
        .unionByName(taken.where(F.col("position") <= shared).select(*columns))
        .unionByName(
            convs.select(
                "conv_id",
                F.lit(0).cast("long").alias("position"),
                F.lit(None).cast("binary").alias("turn"),
                F.lit(0).cast("long").alias("n_chars"),
            )
        )
    )


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


_CRC = """xor(4294967295::ubigint, list_reduce(
      list_prepend(4294967295::ubigint,
                   list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::ubigint)),
      lambda a, c: list_reduce(list_prepend(xor(a, c), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
                               lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1)))))"""

OP11_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn AS said, row_number() OVER (PARTITION BY conv_id ORDER BY t NULLS FIRST, turn) AS position,
         n_chars
  FROM (SELECT conv_id, turn AS t, length(coalesce(text, '')) AS n_chars,
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
                      || strlen(coalesce(text, '')) || ':' || coalesce(text, '')) AS turn
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, conv_id - conv_id % {BLOCK} AS block, {_CRC} % {MOST_SHARED} AS shared
  FROM (SELECT DISTINCT conv_id FROM turns)),
mixed AS (
  SELECT c.conv_id, t.position, said, n_chars
  FROM convs AS c JOIN turns AS t ON t.conv_id = c.block AND t.position <= c.shared
  UNION ALL
  SELECT c.conv_id, t.position, said, n_chars
  FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND t.position > c.shared),
cells AS (
  SELECT conv_id, row_number() OVER w AS depth, n_chars, string_agg(said, '') OVER w AS node
  FROM mixed WINDOW w AS (PARTITION BY conv_id ORDER BY position)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS depth FROM cells GROUP BY ALL),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, depth, count(*) AS n_convs, min(n_chars) AS n_chars,
         sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id)
                         FILTER (depth = (SELECT l.depth FROM lengths AS l WHERE l.conv_id = cells.conv_id)),
                         '')) AS ends_sha256
  FROM cells GROUP BY node, depth),
linked AS (
  SELECT n.*, p.node AS parent, p.conv_id AS parent_conv_id
  FROM nodes AS n
  LEFT JOIN cells AS c ON c.conv_id = n.conv_id AND c.depth = n.depth - 1
  LEFT JOIN nodes AS p ON p.node = c.node),
counted AS (
  SELECT l.*, coalesce(c.n_children, 0) AS n_children
  FROM linked AS l
  LEFT JOIN (SELECT parent, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY parent) AS c
    ON c.parent = l.node),
subtrees AS (
  SELECT c.node, count(*) FILTER (b.n_children = 0) AS n_leaves,
         sum((b.n_convs - 1) * b.n_chars)::bigint AS saved_tokens
  FROM counted AS b JOIN cells AS c ON c.conv_id = b.conv_id AND c.depth <= b.depth
  GROUP BY c.node)
SELECT conv_id, depth::bigint AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
       ends_sha256
FROM counted JOIN subtrees USING (node)
"""
