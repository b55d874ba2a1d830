"""Merkle manifest of a table: one root digest, and for every row a proof that it belongs to it.

Each row is a leaf. The leaves of a group form a tree, in key order and with ``FANOUT`` children
a node; the group roots form one more tree above them. A level is computed by a sibling-shift
self-join: a node looks up the nodes at the shifted slots of its own run by an equijoin on
(tree, index), which gives its siblings, left and right of it. The row in slot zero then emits the
parent. No group of rows is gathered beyond the ``FANOUT`` nodes of one run, so one hot group
is spread like any other, and texts are hashed in the scan and never shuffled.

A proof is the path of a leaf: at each level the digests left and right of it. Paths are put
together from the root down, so that a path is stored once per run and not once per row. Folding a
leaf along its path gives the root again, unless leaf or path were changed.

Nulls and edge cases: a null field is ``-``, so it differs from an empty one (``0:``). Null groups
are a group of their own, the first; null keys come first in their group. Rows that share a key
are separate leaves, ordered by their digests; equal rows are interchangeable. A group of one row
has its leaf as its root, and a table of one group that root as its own. An empty table has no
rows in its manifest. Long texts cost one pass of the hash function. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebase.llm.mixing import running_totals
from carebase.llm.text import ascii_lower
from carebase.session import written

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<before:binary,after:binary>"


def field(value: Column) -> Column:
    """The UTF-8 byte count, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def hashed(*parts: Column) -> Column:
    """Binary SHA-256 of the parts, one after the other."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def as_hex(digests: Column) -> Column:
    """Digests as lowercase hex text, as they enter the next digest."""
    return F.lower(F.hex(digests))


def parent_of(before: Column, digest: Column, after: Column) -> Column:
    return hashed(as_hex(F.concat(before, digest, after)))


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Adds ``before`` and ``after``, the digests of a node's run left and right of it.

    ``nodes`` is (tree, idx, digest, n). Every node asks for the index of each slot of its run,
    its own one shifted by 0 to ``fanout - 1``, and finds the nodes there by an equijoin.
    """
    idx = F.col("idx")
    asked = nodes.select("tree", "idx", "n", F.explode(F.sequence(F.lit(0), F.lit(fanout - 1))).alias("shift"))
    asked = asked.withColumn("sibling", idx - idx % fanout + (idx + F.col("shift")) % fanout)
    there = nodes.select("tree", F.col("idx").alias("sibling"), "digest")
    found = asked.where("sibling < n").join(there, ["tree", "sibling"])
    run = found.groupBy("tree", "idx", "n").agg(
        F.sort_array(F.collect_list(F.struct("sibling", "digest"))).alias("run")
    )

    def joined(condition) -> Column:
        digests = F.transform(F.filter("run", condition), lambda node: node["digest"])
        return F.aggregate(digests, F.lit(b""), lambda all_, one: F.concat(all_, one))

    return run.select(
        "tree",
        "idx",
        "n",
        joined(lambda node: node["sibling"] < idx).alias("before"),
        joined(lambda node: node["sibling"] == idx).alias("digest"),
        joined(lambda node: node["sibling"] > idx).alias("after"),
    )


def build_levels(nodes: DataFrame, largest: int, fanout: int = FANOUT) -> tuple[list, list]:
    """The levels of all trees at once, and the roots that were reached below each level.

    ``nodes`` is (tree, idx, digest, n) with n the nodes of the tree, ``largest`` the largest n.
    The number of levels grows with the logarithm of ``largest``; each is stored.
    """
    levels, roots = [], [nodes.where("n = 1").select("tree", "digest")]
    while largest > 1:
        level = written(with_siblings(nodes.where("n > 1"), fanout), "manifest_level")
        nodes = level.where(F.col("idx") % fanout == 0).select(
            "tree",
            F.floor(F.col("idx") / fanout).alias("idx"),
            parent_of(F.col("before"), F.col("digest"), F.col("after")).alias("digest"),
            F.ceil(F.col("n") / fanout).alias("n"),
        )
        levels.append(level)
        roots.append(nodes.where("n = 1").select("tree", "digest"))
        largest = -(-largest // fanout)
    return levels, roots


def build_paths(levels: list, roots: list, above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(tree, idx, path) of every leaf, and the other columns of ``above``.

    ``above`` has one row per tree with the path from its root upwards. From the top level down,
    every node puts its own siblings in front of the path of its parent.
    """
    kept = [name for name in above.columns if name not in ("tree", "path")]
    paths = None
    for k in reversed(range(len(roots))):
        tops = roots[k].select("tree", F.lit(0).cast("long").alias("idx")).join(above, "tree")
        if paths is None:
            paths = tops
            continue
        step = F.struct("before", "after").cast(STEP)
        below = levels[k].select(
            "tree", "idx", F.floor(F.col("idx") / fanout).alias("parent"), step.alias("step")
        )
        upper = paths.withColumnRenamed("idx", "parent")
        below = below.join(upper, ["tree", "parent"]).select(
            "tree", "idx", F.concat(F.array("step"), "path").alias("path"), *kept
        )
        paths = below.unionByName(tops)
    return paths


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives along its path."""
    return F.aggregate(path, leaf, lambda node, step: parent_of(step["before"], node, step["after"]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    sides = F.transform(path, lambda step: as_hex(F.concat(step["before"], step["after"])))
    return F.sha2(F.concat(F.lit(""), F.array_join(sides, "")), 256)


def _placed(leaves: DataFrame, tree: Column, order: Sequence[Column]) -> tuple[DataFrame, int]:
    """``leaves`` with tree, idx in the tree and n, stored; and the largest n."""
    leaves = leaves.withColumn("tree", tree)
    ranked = written(running_totals(leaves, order, {"rank": F.lit(1)}), "manifest_ranked")
    trees = ranked.groupBy("tree").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    placed = ranked.join(trees, "tree").withColumn("idx", F.col("rank") - F.col("first"))
    placed = written(placed.drop("rank", "first"), "manifest_leaves")
    return placed, placed.agg(F.max("n")).first()[0] or 0


def manifest(
    df: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    changed: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """(key, group, leaf, subroot, root, path, seen): the manifest and what is to be verified.

    ``changed`` replaces fields in the rows as they are seen later; ``seen`` is the leaf of the
    row with these. ``folded(seen, path)`` equals ``root`` when nothing was changed.
    """
    now = changed or {}
    leaf = hashed(*(field(F.col(f"`{name}`")) for name in fields))
    seen = hashed(*(field(now.get(name, F.col(f"`{name}`"))) for name in fields)) if now else leaf
    leaves = df.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{group}`").cast("string").alias("group"),
        leaf.alias("digest"),
        seen.alias("seen"),
        # Equal rows are told apart, so that many copies still fall into many ranges.
        F.monotonically_increasing_id().alias("copy"),
    )
    order = [F.col(name).asc_nulls_first() for name in ("group", "key", "digest", "copy")]
    placed, largest = _placed(leaves, field(F.col("group")), order)
    levels, roots = build_levels(placed.select("tree", "idx", "digest", "n"), largest, fanout)

    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    group_of = F.when(F.col("tree") != "-", F.expr("substr(tree, instr(tree, ':') + 1)"))
    subroots = subroots.select(F.col("tree").alias("below"), "digest", group_of.alias("group"))
    tops, largest = _placed(subroots, F.lit(""), [F.col("group").asc_nulls_first()])
    top_levels, top_roots = build_levels(tops.select("tree", "idx", "digest", "n"), largest, fanout)
    root = top_roots[0]
    for more in top_roots[1:]:
        root = root.unionByName(more)
    root = root.select("tree", F.array().cast(f"array<{STEP}>").alias("path"), F.col("digest").alias("root"))
    above = build_paths(top_levels, top_roots, root, fanout)
    above = tops.join(above, ["tree", "idx"]).select(
        F.col("below").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
    )
    paths = build_paths(levels, roots, written(above, "manifest_subroots"), fanout)
    return placed.join(paths, ["tree", "idx"]).select(
        F.col("key").alias(key),
        F.col("group").alias(group),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        "seen",
    )


def op13_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    is_changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(is_changed, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    proofs = manifest(docs, changed={"text": text})
    proofs = proofs.withColumn("folded_root", folded(F.col("seen"), F.col("path")))
    return proofs.select(
        "doc_id",
        as_hex(F.col("leaf")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        as_hex(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        as_hex(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# CRC-32 of the decimal digits, bit by bit.
_CRC = """xor(4294967295::ubigint, list_reduce(
      list_prepend(4294967295::ubigint,
                   list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::ubigint)),
      lambda a, c: list_reduce(list_prepend(xor(a, c), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
                               lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1)))))"""


def _sql_leaf(text: str = "text") -> str:
    values = [text if name == "text" else name for name in FIELDS]
    parts = (f"coalesce(strlen({v}::varchar) || ':' || {v}, '-')" for v in values)
    return f"sha256({' || '.join(parts)})"


def _sql_tree(name: str, leaves: str) -> str:
    """``name``: all nodes (tree, level, idx, n, digest) above the rows of ``leaves``."""
    return f"""{name} AS (
      SELECT tree, 0 AS level, idx, n, digest FROM {leaves}
      UNION ALL
      SELECT tree, level + 1, idx // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT},
             sha256(string_agg(digest, '' ORDER BY idx))
      FROM {name} WHERE n > 1 GROUP BY tree, level, idx // {FANOUT}, n)"""


def _sql_walk(name: str, start: str, tree: str) -> str:
    """``name``: from the rows of ``start`` up to their root, with the proof and the fold."""
    side = "(SELECT coalesce(string_agg(digest, '' ORDER BY s.idx), '') FROM {t} AS s WHERE {same})"
    same = f"s.tree = w.tree AND s.level = w.level AND s.idx // {FANOUT} = w.idx // {FANOUT} AND s.idx {{}} w.idx"
    left = side.format(t=tree, same=same.format("<"))
    right = side.format(t=tree, same=same.format(">"))
    return f"""{name} AS (
      SELECT id, tree, 0 AS level, idx, n, proof, node FROM {start}
      UNION ALL
      SELECT id, tree, level + 1, idx // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT},
             proof || l || r, sha256(l || node || r)
      FROM (SELECT w.*, {left} AS l, {right} AS r FROM {name} AS w WHERE w.n > 1))"""


OP13_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT *, CASE WHEN {_CRC} % 3 = 0
                 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                 ELSE text END AS later
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
         count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS id
  FROM (SELECT doc_id, lang, coalesce('=' || lang, '') AS tree, {_sql_leaf()} AS digest,
               {_sql_leaf("later")} AS seen FROM docs)),
{_sql_tree("nodes", "leaves")},
subroots AS (
  SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n,
         digest, tree AS lang_tree
  FROM nodes WHERE n = 1),
{_sql_tree("tops", "subroots")},
starts AS (SELECT id, tree, idx, n, '' AS proof, seen AS node FROM leaves),
{_sql_walk("walk", "starts", "nodes")},
halfway AS (
  SELECT w.id, s.tree, s.idx, s.n, w.proof, w.node, s.digest AS subroot
  FROM walk AS w JOIN subroots AS s ON w.tree = s.lang_tree WHERE w.n = 1),
{_sql_walk("climb", "halfway", "tops")}
SELECT leaves.doc_id, leaves.digest AS leaf, subroot, tops.digest AS root,
       sha256(climb.proof) AS proof_sha256, climb.node AS folded_root,
       climb.node = tops.digest AS verified
FROM leaves JOIN halfway USING (id) JOIN climb USING (id) JOIN tops ON tops.n = 1
WHERE climb.n = 1
"""
