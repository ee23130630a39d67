"""A Merkle manifest of a table: blocks of hash trees in van Emde Boas order, proofs from them, and their verification.

H is the lowercase hexadecimal SHA-256 of its inputs joined, digests as hexadecimal text. A leaf is H of doc_id, source, lang, n_chars and text, each ``-`` if null,
else its number of UTF-8 bytes, ``:`` and the value. The leaves of one lang ascend by doc_id; while several nodes remain, every two neighbours, and a last
one alone, become their H. What remains is the subroot of the lang; subroots in order of lang (null first, bytewise) give the root in the same way.

A tree is cut into aligned subtrees of HEIGHT levels of edges, one row each. The roots of the blocks of one tier are the leaves of the next, so a tree of 2**30
leaves has three tiers, and no task ever holds more than one block. In a block nodes lie in van Emde Boas order: a tree of h levels is its upper half, then each
lower tree, each laid out likewise, and the place of a node follows from its depth and index by arithmetic alone (``place``), for writing
as for finding siblings. Proofs go down again: a block of the lower tier gets the path of its root from the tier above.

Nulls are digested as ``-``; rows with a null doc_id come after all others of their lang, and nobody tampers with them. Rows that share a doc_id are leaves of their own,
in order of their digests. Empty and very long texts are texts like others (only digests travel). An empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import passing, per_batch, ranked, small_enough, stored

#: A block has at most 2**HEIGHT leaves.
HEIGHT = 10
#: At most so many paths of blocks (about 2 kB each) or langs go out as a broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 20_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def place(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places, from 0, of the nodes ``index`` at ``depth`` (root: 0) of a complete tree of ``levels`` levels in van Emde Boas order."""
    at, index = np.zeros(len(index), np.int64), np.asarray(index, np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        lower = levels - upper
        below = depth - upper  # depth within the lower tree
        at += (1 << upper) - 1 + (index >> below) * ((1 << lower) - 1)
        index, depth, levels = index & ((1 << below) - 1), below, lower
    return at


@cache
def level_places(height: int, level: int) -> np.ndarray:
    """Places of all nodes of a level (leaves: 0) of a block with ``height`` levels of edges."""
    return place(height + 1, height - level, np.arange(1 << (height - level)))


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def block_nodes(leaves: list[str], height: int) -> np.ndarray:
    """All nodes over ``leaves``, 32 bytes each, in van Emde Boas order; places without a node are zero."""
    nodes, own = np.zeros(((2 << height) - 1, 32), np.uint8), leaves
    for level in range(height + 1):
        nodes[level_places(height, level)[: len(own)]] = np.frombuffer(bytes.fromhex("".join(own)), np.uint8).reshape(-1, 32)
        own = [digest(*own[i : i + 2]) for i in range(0, len(own), 2)]
    return nodes


def siblings(nodes: np.ndarray, height: int, n: int, index: int) -> list[str]:
    """The path of a leaf to the root of its block: for each level ``L`` or ``R`` for the side of its sibling with that sibling, or nothing for a node alone."""
    path = []
    for level in range(height):
        other = (index >> level) ^ 1
        if other < -(-n >> level):
            path.append("LR"[other & 1] + nodes[level_places(height, level)[other]].tobytes().hex())
        else:
            path.append("")
    return path


def folded(leaf: str, path: list[str], known: dict) -> str:
    """The root that ``leaf`` and its siblings give. ``known`` remembers steps that several leaves of a block share."""
    for step in path:
        key = (leaf, step)
        if key not in known:
            known[key] = digest(leaf) if not step else digest(step[1:], leaf) if step[0] == "L" else digest(leaf, step[1:])
        leaf = known[key]
    return leaf


def top_height(n: int, most: int) -> int:
    """Levels of edges of a block in a tier of n leaves: all if there is more than one block, else what n needs."""
    return most if n > 1 << most else (n - 1).bit_length()


def _build(batches, most: int):
    for batch in batches:
        out = []
        for n, leaves in zip(batch.column("n").to_pylist(), batch.column("leaves").to_pylist(), strict=True):
            h = top_height(n, most)
            nodes = block_nodes(leaves, h)
            out.append((nodes.tobytes(), nodes[0].tobytes().hex()))
        cols = [batch.column(c) for c in ("tree", "n", "block")]
        cols += [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())]
        yield pa.RecordBatch.from_arrays(cols, names=["tree", "n", "block", "nodes", "top"])


def tier(leaves: DataFrame, most: int) -> DataFrame:
    """tree, n, block, nodes, top of the blocks over ``leaves`` (tree, n, pos, digest); n is the number of leaves of the whole tree."""
    rows = leaves.groupBy("tree", "n", F.shiftright("pos", most).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("x"))
    rows = rows.select("tree", "n", "block", F.transform("x", lambda x: x["digest"]).alias("leaves"))
    return per_batch(rows, lambda b: _build(b, most), "tree long, n long, block long, nodes binary, top string")


def tiers(leaves: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of blocks over ``leaves``, and tree, top of the finished trees."""
    found, done, rows = [], None, leaves
    while True:
        blocks = stored(tier(rows, most), "tier")
        found.append(blocks)
        whole = blocks.where(F.col("n") <= 1 << most).select("tree", "top")
        done = whole if done is None else done.union(whole)
        above = blocks.where(F.col("n") > 1 << most)
        if above.isEmpty():
            return found, done
        rows = above.select("tree", F.shiftright(F.col("n") + (1 << most) - 1, most).alias("n"), F.col("block").alias("pos"), F.col("top").alias("digest"))


def _paths(batches, most: int):
    """The path of each leaf of blocks to the root of all trees: its siblings within the block, then those above the block."""
    for batch in batches:
        out = {"tree": [], "pos": [], "path": [], "subroot": []}
        for row in batch.to_pylist():
            h = top_height(row["n"], most)
            nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
            own = min(1 << most, row["n"] - (row["block"] << most))
            for i in range(own):
                leaf = nodes[level_places(h, 0)[i]].tobytes().hex()
                out["tree"].append(row["tree"])
                out["pos"].append((row["block"] << most) + i)
                out["path"].append(siblings(nodes, h, own, i) + (row["above"] or []))
                out["subroot"].append(row["subroot"] or leaf)
        yield pa.RecordBatch.from_pydict(out, pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("path", pa.list_(pa.string())), ("subroot", pa.string())]))


def _proofs(batches, most: int, root: str):
    for batch in batches:
        out = {k: [] for k in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")}
        for row in batch.to_pylist():
            h, known = top_height(row["n"], most), {}
            nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
            for i, doc in enumerate(row["rows"]):
                path = siblings(nodes, h, len(row["rows"]), i) + row["above"]
                got = folded(doc["other"] or doc["digest"], path, known)
                values = (doc["doc_id"], doc["digest"], row["subroot"], root, digest(*[s[1:] for s in path]), got, got == root)
                for k, v in zip(out, values, strict=True):
                    out[k].append(v)
        types = [pa.int64()] + [pa.string()] * 5 + [pa.bool_()]
        yield pa.RecordBatch.from_pydict(out, pa.schema(list(zip(out, types, strict=True))))


def with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with ``above``, the path of their root, and the subroot of their tree. ``paths`` has tree, block, above, subroot."""
    if small_enough(paths, BROADCAST_ROWS):
        paths = F.broadcast(paths)
    return blocks.join(paths, ["tree", "block"])


def leaf(**values: F.Column) -> F.Column:
    """H of the five fields; ``values`` replaces some of them."""
    parts = []
    for name in FIELDS:
        v = values.get(name, F.col(name)).cast("string")
        parts.append(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree, n, pos, doc_id, digest, other: each row's place among its lang's leaves, its digest, and its digest as tampered with (null: it is not)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"))
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    more = (F.col("n_chars").cast("decimal(19,0)") + 1).cast("string")
    rows = docs.select("doc_id", "lang", leaf().alias("digest"), F.when(chosen, leaf(n_chars=more)).alias("other"))
    rows = stored(ranked(rows, F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_last(), F.col("digest")), "leaves")
    trees = rows.groupBy(F.col("lang").alias("own")).agg(F.min("rank").alias("tree"), F.count("*").alias("n"))
    trees = F.broadcast(trees) if small_enough(trees, BROADCAST_ROWS) else trees.hint("merge")
    rows = rows.join(trees, F.col("lang").eqNullSafe(F.col("own")))
    return rows.select("tree", "n", (F.col("rank") - F.col("tree")).alias("pos"), "doc_id", "digest", "other")


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``docs`` (doc_id, source, lang, n_chars, text)."""
    with passing(docs.sparkSession) as keep:
        rows = stored(leaves(docs), "placed")
        found, tops = tiers(rows.select("tree", "n", "pos", "digest"), height)
        # The trees by themselves are the leaves of one more tree, whose number is -1.
        tops = ranked(tops, F.col("tree")).select(F.col("tree").alias("own"), F.col("rank").alias("pos"), F.col("top").alias("digest"))
        n = tops.count()
        above, last = tiers(tops.select(F.lit(-1).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), "pos", "digest"), height)
        root = last.first()
        root = root["top"] if root else ""
        paths = None
        for blocks in reversed(above):
            blocks = blocks.withColumn("above", F.lit(None).cast("array<string>")).withColumn("subroot", F.lit(None).cast("string")) if paths is None else with_paths(blocks, paths)
            paths = per_batch(blocks, lambda b: _paths(b, height), "tree long, pos long, path array<string>, subroot string")
            paths = stored(paths.select("tree", F.col("pos").alias("block"), F.col("path").alias("above"), "subroot"), "paths")
        # Of the one tree of subroots, each leaf is its own subroot.
        own = paths.join(tops.select("own", F.col("pos").alias("block"), "digest"), "block").select(F.col("own").alias("tree"), F.lit(0).cast("long").alias("block"), "above", F.col("digest").alias("subroot"))
        own = stored(own, "subroots")
        paths = own
        for blocks in reversed(found[1:]):
            # A tier holds the topmost block of some trees and lower blocks of others.
            lower = per_batch(with_paths(blocks, paths), lambda b: _paths(b, height), "tree long, pos long, path array<string>, subroot string")
            lower = lower.select("tree", F.col("pos").alias("block"), F.col("path").alias("above"), "subroot")
            paths = stored(lower.union(own.join(lower.select("tree").distinct(), "tree", "left_anti")), "paths")
        docs_of = rows.groupBy("tree", F.shiftright("pos", height).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "doc_id", "digest", "other"))).alias("rows"))
        blocks = with_paths(found[0].join(docs_of, ["tree", "block"]), paths)
        schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return keep(per_batch(blocks.select("tree", "n", "block", "nodes", "rows", "above", "subroot"), lambda b: _proofs(b, height, root), schema), "proofs")


def _field(v: str) -> str:
    return f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v}::VARCHAR END"


_HEAD, _TAIL = " || ".join(map(_field, FIELDS[:3])), _field("text")
_STEP = "CASE WHEN x >= 1000 THEN xor(a, x - 1000) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
_CRC = f"xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [1000 + ord(c), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[])), lambda a, x: {_STEP}), 4294967295)"
_PAIRED = "list_transform(range((len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], '')))"
ORACLE_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, sha256({_HEAD} || {_field("n_chars")} || {_TAIL}) AS leaf,
    sha256({_HEAD} || CASE WHEN {_CRC} % 7 = 0 THEN {_field("(n_chars + 1)")} ELSE {_field("n_chars")} END || {_TAIL}) AS held
  FROM documents),
lv AS (SELECT lang, 0 AS level, list(leaf ORDER BY doc_id) AS l FROM d GROUP BY lang
       UNION ALL SELECT lang, level + 1, {_PAIRED} FROM lv WHERE len(l) > 1),
subroots AS MATERIALIZED (SELECT lang, l[1] AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM lv WHERE len(l) = 1),
tv AS (SELECT 0 AS level, list(subroot ORDER BY pos) AS l FROM subroots
       UNION ALL SELECT level + 1, {_PAIRED} FROM tv WHERE len(l) > 1),
steps AS (
  SELECT doc_id, level AS step, pos >> level AS p, l FROM d JOIN lv ON d.lang IS NOT DISTINCT FROM lv.lang WHERE len(l) > 1
  UNION ALL SELECT doc_id, s.height + tv.level, s.pos >> tv.level, tv.l FROM d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang, tv WHERE len(tv.l) > 1),
sides AS (SELECT doc_id, step, CASE WHEN p % 2 = 1 THEN 'L' || l[p] WHEN p + 2 <= len(l) THEN 'R' || l[p + 2] ELSE '' END AS s FROM steps),
paths AS (SELECT doc_id, list(s ORDER BY step) AS path FROM sides GROUP BY doc_id),
out AS (
  SELECT d.doc_id, leaf, subroot, (SELECT l[1] FROM tv WHERE len(l) = 1) AS root,
    sha256(coalesce(array_to_string(list_transform(path, lambda s: s[2:]), ''), '')) AS proof_sha256,
    list_reduce([held] || coalesce(path, []), lambda h, s: CASE WHEN s = '' THEN sha256(h) WHEN s[1] = 'L' THEN sha256(s[2:] || h) ELSE sha256(h || s[2:]) END) AS folded_root
  FROM d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang LEFT JOIN paths ON d.doc_id = paths.doc_id)
SELECT *, folded_root = root AS verified FROM out"""
