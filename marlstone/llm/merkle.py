"""Merkle trees over groups of rows, and proofs that a whole partition of leaves shares.

A forest has one binary tree per group (null is a group); the trees' roots, in the order of their groups, are
the leaves of one more tree. A partition of leaves that want proofs computes which nodes its proofs lack and
cannot derive from one another, fetches these once, derives what they share, and folds each proof by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.llm.links import cut

#: Levels that one task adds to a tree at a time, over 2^TIER nodes.
TIER = 14
#: Leaves of a partition that shares a proof.
PART_LEAVES = 1 << 13


def leaf_hash(*values: Column) -> Column:
    """SHA-256 of the values, each as its length in bytes, a colon and its text; a null is a dash."""
    texts = [value.cast("string") for value in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above ``n`` leaves."""
    return (n - 1).bit_length()


def width(n: int, level: int) -> int:
    return -(-n >> level)


@dataclass
class Forest:
    """``leaves(tree, key, at, n, hash, ...)``: position in the tree and its number of leaves;
    ``nodes(tree, level, at, hash)`` above them; ``tops(tree, hash)``, one row per tree."""

    leaves: DataFrame
    nodes: DataFrame
    tops: DataFrame


def _placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``at`` and ``n``: place by key (nulls first; equal keys by hash) and size of the tree.

    Rows are dealt by ranges, so a tree of any size is spread, and equal rows too (their order does not
    matter). One row for each tree of a partition is added up to say where the tree's rows there begin.
    """
    order = [F.asc_nulls_first("tree"), F.asc_nulls_first("key"), F.asc("hash"), F.asc("_row")]
    named = cut(leaves).withColumn("_row", F.monotonically_increasing_id())
    ranged = cut(named.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row"))
    ranged = ranged.withColumn("_m", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_m", 33))
    by = Window.partitionBy("tree")
    before = by.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = ranged.groupBy("tree", "_p").agg(F.min("_m").alias("_first"), F.count("*").alias("_n")).select(
        F.col("tree").alias("_tree"), F.col("_p").alias("_part"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(by).alias("n"))
    placed = ranged.join(runs, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_p") == F.col("_part")))
    return placed.withColumn("at", F.col("_m") + F.col("_shift")).select(*leaves.columns, "at", "n")


def _climb(level: int):
    """Interior nodes over one aligned block of ``level``'s nodes: (tree, level, at, n, hash)."""

    def run(table: pa.Table) -> pa.Table:
        at, n = np.array(table["at"]), table["n"][0].as_py()
        order = np.argsort(at)
        low = int(at[order[0]])
        nodes = table["hash"].take(pa.array(order)).to_pylist()
        out: list[list] = [[], [], []]
        for k in range(level, level + TIER):
            if width(n, k) == 1:
                break
            nodes = [_hash("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
            low >>= 1
            out[0] += [k + 1] * len(nodes)
            out[1] += range(low, low + len(nodes))
            out[2] += nodes
        tree = table["tree"].slice(0, 1).combine_chunks()
        return pa.table({
            "tree": tree.take(pa.array(np.zeros(len(out[0]), np.int64))), "level": pa.array(out[0], pa.int32()),
            "at": pa.array(out[1], pa.int64()), "n": pa.array([n] * len(out[0]), pa.int64()), "hash": pa.array(out[2], pa.string())})

    return run


def grow(leaves: DataFrame) -> Forest:
    """The forest over ``leaves`` (tree, key, hash; further columns stay). Every 2 consecutive nodes are
    hashed together, a last one alone, until one remains; a tree of one leaf is that leaf.

    A task takes an aligned block of 2^TIER nodes up TIER levels, so the number of rounds is the depth
    of the largest tree over TIER, and no task sees more than a block. An empty table gives an empty forest.
    """
    placed = cut(_placed(leaves))
    kind = leaves.schema["tree"].dataType.simpleString()
    shape = f"tree {kind}, level int, at long, n long, hash string"
    largest = placed.agg(F.max("n")).first()[0] or 0
    rows, pieces = placed.select("tree", "at", "n", "hash"), []
    for level in range(0, max(1, depth(largest)) if largest > 1 else 0, TIER):
        block = F.shiftright("at", TIER).alias("block")
        grown = cut(rows.groupBy("tree", block).applyInArrow(_climb(level), shape))
        pieces.append(grown)
        rows = grown.where(F.col("level") == level + TIER).select("tree", "at", "n", "hash")
    nodes = pieces[0] if pieces else leaves.sparkSession.createDataFrame([], shape)
    for piece in pieces[1:]:
        nodes = nodes.unionByName(piece)
    tops = placed.where("n = 1").select("tree", "hash").unionByName(
        nodes.where("level = length(bin(n - 1))").select("tree", "hash"))
    return Forest(placed, nodes.select("tree", "level", "at", "hash"), tops)


def missing(at: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes that the proofs of the leaves ``at`` need beside what these leaves give.

    A sibling on a level is derived where a wanted leaf stands under it, absent beyond the end of the level,
    and else missing; no node is named twice.
    """
    out, own = [], np.unique(at)
    for level in range(depth(n)):
        beside = own ^ 1
        lacking = beside[(beside < width(n, level)) & ~np.isin(beside, own)]
        out += [(level, int(k)) for k in lacking]
        own = np.unique(own >> 1)
    return out


def _missing(key: tuple, table: pa.Table) -> pa.Table:
    found = missing(np.array(table["at"]), table["n"][0].as_py())
    return pa.table({
        "tree": pa.array([key[0].as_py()] * len(found), table.schema.field("tree").type),
        "part": pa.array([key[1].as_py()] * len(found), pa.int64()),
        "level": pa.array([x for x, _ in found], pa.int32()), "at": pa.array([x for _, x in found], pa.int64())})


def siblings(at: int, n: int, levels: list[dict[int, str]]) -> list[tuple[bool, str] | None]:
    """Level by level the other node of the leaf's run and whether it stands left; None where there is none."""
    out: list[tuple[bool, str] | None] = []
    for level in range(depth(n)):
        beside = at ^ 1
        out.append((beside < at, levels[level][beside]) if beside < width(n, level) else None)
        at >>= 1
    return out


def fold(leaf: str, path: list[tuple[bool, str] | None]) -> str:
    """The root that a leaf and its path give."""
    for step in path:
        leaf = _hash(leaf if step is None else step[1] + leaf if step[0] else leaf + step[1])
    return leaf


def derive(at: list[int], n: int, leaves: list[str], fetched: list[tuple[int, int, str]]) -> list[dict[int, str]]:
    """All nodes that the leaves and the fetched nodes give, by level and place."""
    levels: list[dict[int, str]] = [{} for _ in range(depth(n) + 1)]
    levels[0].update(zip(at, leaves))
    own = np.unique(np.array(at))
    for level, place, node in fetched:
        levels[level][place] = node
    for level in range(depth(n)):
        known, above, last = levels[level], levels[level + 1], width(n, level)
        own = np.unique(own >> 1)
        for k in own.tolist():
            above[k] = _hash(known[2 * k] + known[2 * k + 1] if 2 * k + 1 < last else known[2 * k])
    return levels


_PATH = "array<struct<absent:boolean,left:boolean,hash:string>>"


def _expand(with_path: bool, columns: list[str]):
    def run(leaves: pa.Table, shared: pa.Table) -> pa.Table:
        n, at = leaves["n"][0].as_py(), leaves["at"].to_pylist()
        row = shared.slice(0, 1).to_pylist()[0] if shared.num_rows else {}
        fetched = [(x["level"], x["at"], x["hash"]) for x in row.get("fetched") or []]
        above = [None if x["absent"] else (x["left"], x["hash"]) for x in row.get("above") or []]
        levels = derive(at, n, leaves["hash"].to_pylist(), fetched)
        proofs, folded, paths = [], [], []
        for place, claim in zip(at, leaves["claim"].to_pylist()):
            path = siblings(place, n, levels) + above
            proofs.append(_hash("".join(step[1] for step in path if step)))
            folded.append(fold(claim, path))
            if with_path:
                paths.append([{"absent": s is None, "left": bool(s and s[0]), "hash": s[1] if s else None} for s in path])
        out = {c: leaves[c] for c in columns}
        out["proof_sha256"], out["folded"] = pa.array(proofs, pa.string()), pa.array(folded, pa.string())
        if with_path:
            step = pa.struct([("absent", pa.bool_()), ("left", pa.bool_()), ("hash", pa.string())])
            out["path"] = pa.array(paths, pa.list_(step))
        return pa.table(out)

    return run


def prove(forest: Forest, wanted: DataFrame, above: DataFrame | None = None, with_path: bool = False) -> DataFrame:
    """``wanted`` (rows of ``forest.leaves``, any of them, with a column ``claim``: the leaf hash to be folded)
    with ``proof_sha256`` (SHA-256 of its siblings from the leaf up, left to right) and ``folded`` (the root
    that the claim and these siblings give); ``with_path`` adds the siblings, a level a step.

    ``above`` (tree, path) continues every proof of a tree. A partition is up to ``PART_LEAVES`` neighbouring
    leaves of one tree; its missing nodes travel to it once.
    """
    part = F.floor(F.col("at") / PART_LEAVES).cast("long").alias("part")
    parted = wanted.select("*", part)
    kind = wanted.schema["tree"].dataType.simpleString()
    asked = parted.select("tree", "part", "at", "n").groupBy("tree", "part").applyInArrow(
        _missing, f"tree {kind}, part long, level int, at long")
    nodes = forest.nodes.unionByName(forest.leaves.select("tree", F.lit(0).alias("level"), "at", "hash"))
    nodes = nodes.select(F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("at").alias("_at"), "hash")
    found = asked.join(
        nodes, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("level") == F.col("_level")) & (F.col("at") == F.col("_at")))
    shared = found.groupBy("tree", "part").agg(F.collect_list(F.struct("level", "at", "hash")).alias("fetched"))
    if above is None:
        shared = shared.withColumn("above", F.lit(None).cast(_PATH))
    else:  # a partition that lacks nothing of its own tree still goes on above it
        parts = parted.select(F.col("tree").alias("_tree"), F.col("part").alias("_part")).distinct()
        parts = parts.join(
            shared, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("part") == F.col("_part")), "left"
        ).select(F.col("_tree").alias("tree"), F.col("_part").alias("part"), "fetched")
        above = above.select(F.col("tree").alias("_tree"), F.col("path").alias("above"))
        shared = parts.join(above, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema)
    shape += ", proof_sha256 string, folded string" + (f", path {_PATH}" if with_path else "")
    return parted.groupBy("tree", "part").cogroup(shared.groupBy("tree", "part")).applyInArrow(
        _expand(with_path, wanted.columns), shape)


def manifest(docs: DataFrame, fields: list[str], key: str = "doc_id", group: str = "lang", **tampered: Column) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A leaf hashes ``fields`` in their order. Leaves of a group ascend by ``key`` (nulls first, rows of one key
    by leaf; equal rows have equal leaves); subroots ascend by group (null first, by code point). ``tampered`` names
    fields with the values claimed for them: the proof of a row that claims another leaf than its own folds to
    another root. Only keys, groups and hashes travel; texts are read once.
    """
    own = leaf_hash(*[F.col(f"`{c}`") for c in fields])
    claim = leaf_hash(*[tampered.get(c, F.col(f"`{c}`")) for c in fields]) if tampered else own
    changed = F.lit(False)
    for c, value in tampered.items():
        changed = changed | ~value.eqNullSafe(F.col(f"`{c}`"))
    leaves = docs.select(
        F.col(f"`{group}`").cast("string").alias("tree"), F.col(f"`{key}`").alias("key"), own.alias("hash"),
        F.when(changed, claim).alias("claimed"))
    forest = grow(leaves)
    tops = cut(forest.tops)
    upper = grow(tops.select(F.lit(0).alias("tree"), F.col("tree").alias("key"), "hash"))
    paths = prove(upper, upper.leaves.withColumn("claim", F.col("hash")), with_path=True)
    paths = cut(paths.select(F.col("key").alias("tree"), F.col("hash").alias("subroot"), F.col("folded").alias("root"), "path"))
    wanted = forest.leaves.withColumn("claim", F.coalesce("claimed", "hash")).drop("claimed")
    proved = prove(forest, wanted, paths.select("tree", "path"))
    heads = paths.select(F.col("tree").alias("_tree"), "subroot", "root")
    return proved.join(heads, F.col("tree").eqNullSafe(F.col("_tree"))).select(
        F.col("key").alias(key), F.col("hash").alias("leaf"), "subroot", "root", "proof_sha256",
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; where 7 divides the id's crc32, a document claims one character more than it has."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], n_chars=more)


#: The same rows by recursion over levels; the reduce over 8 zeros fills the table of crc32, the other one applies it.
OP11_SQL = """
WITH RECURSIVE steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t FROM range(256) r(i)
), marked AS (
  SELECT d.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
              lambda c, b: xor(c >> 8, steps.t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS hit
  FROM documents d, steps
), fields AS (
  SELECT *, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS f,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS g, CASE WHEN hit THEN n_chars + 1 ELSE n_chars END AS m
  FROM marked
), leaves AS (
  SELECT doc_id, lang, sha256(f || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') || g) AS leaf,
         sha256(f || coalesce(octet_length(encode(m::VARCHAR)) || ':' || m, '-') || g) AS claim FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n
), tops AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2, n
), folded AS (
  SELECT doc_id, leaf, lang, 0 AS level, pos, n, claim AS h, '' AS proof FROM placed
  UNION ALL
  SELECT f.doc_id, f.leaf, f.lang, f.level + 1, f.pos // 2, (f.n + 1) // 2,
         sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.pos < f.pos THEN s.h || f.h ELSE f.h || s.h END), f.proof || coalesce(s.h, '')
  FROM folded f LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM f.lang AND s.level = f.level AND s.pos = xor(f.pos, 1) WHERE f.n > 1
), whole AS (
  SELECT f.doc_id, f.leaf, t.subroot, 0 AS level, t.pos, t.n, f.h, f.proof
  FROM folded f JOIN tops t ON t.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot, f.level + 1, f.pos // 2, (f.n + 1) // 2,
         sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.pos < f.pos THEN s.h || f.h ELSE f.h || s.h END), f.proof || coalesce(s.h, '')
  FROM whole f LEFT JOIN upper_nodes s ON s.level = f.level AND s.pos = xor(f.pos, 1) WHERE f.n > 1
)
SELECT w.doc_id, w.leaf, w.subroot, r.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = r.h AS verified
FROM whole w, upper_nodes r WHERE w.n = 1 AND r.n = 1
"""
