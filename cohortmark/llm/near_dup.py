"""Near-duplicate classes by MinHash with banding, verification and alternating large-star / small-star.

Contract: texts are lower-cased over A-Z and cut into words ``[^\\x20\\x09-\\x0D]+``; a document's set holds its
distinct five-word shingles (the whole sequence as one with fewer words; empty without words). Two documents
are linked if 100 * |A & B| >= 75 * |A | B|; a component is what links reach. Shingles are compared by 64-bit hashes.

Equal sets collapse to one node before any bucket is built, so copies cost one row each. A node's buckets are its bands of minima.

1. Every bucket is linked as a star around its most central node, the one whose buckets hold the most nodes: of many
   near copies of one text that is the text itself, or what is nearest to it.
2. Buckets whose nodes are still in several components are searched exactly, however many nodes they hold and whatever passage put
   them there. Each such node gives the first of its shingles in one order of all shingles, rarest first: sets of the wanted
   similarity share one of these, at places that leave enough shingles after them. Documents that have only a common
   passage in common do not meet, as its shingles come last.

Candidates of both steps are checked by size and signature, then on full sets. So the result misses a link only where two sets at the
threshold of 0.75 share none of 32 bands of 4 (6e-6), or fewer than 66 of 128 minima (about 1e-9; ``floor=0`` asks for none).

Nulls and empty texts have an empty set and stand alone. Repeated rows, and rows that share a doc_id, are rows of their own: each has one result
row. Without any doc_id in its component a row's component_id is null, and it is kept. Ties cannot occur: the smallest doc_id names a component.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytescan as B
from .runtime import BROADCAST_IDS, cut, join_skewed, passing, per_batch, small_enough, stored, text_steps

SHINGLE, PERCENT = 5, 75
#: Buckets come from 32 bands of 4 minima, which are the signature as well.
BANDS, ROWS = 32, 4
SIGNATURE_FLOOR = 0.52
#: Pairs of one hub that a task confirms with one copy of the hub's text.
HUB_PAIRS = 256
#: Shingles of more nodes than this come last, by their number of nodes. At most MOST_COMMON of them are sent out: beyond, the least common
#: ones keep their place among the rare ones, which costs time but changes no result.
COMMON, MOST_COMMON = 16, 1_000_000


def coefficients(n: int, seed: int = 20240607) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift family from 32 to 32 bits: strongly universal for 64-bit a, b."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 64, n, np.uint64, endpoint=False), rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)


def shingle_hashes(data: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows, in row order, and the row of each."""
    low = B.LOWER[data]
    first, last, row = B.words(low, off)
    h = B.span_hashes(low, first, last)
    full, at = B.window_hashes(h, row, k)
    rows = row[at]
    count = np.bincount(row, minlength=len(off) - 1)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):  # the whole sequence, with its length, as one shingle
        begin = np.searchsorted(row, short)
        extra = np.empty(len(short), np.uint64)
        for x, (s, r) in enumerate(zip(begin, short, strict=True)):
            total = 0
            for v in h[s : s + count[r]].tolist():
                total = (total * B.STEP + v) & 0xFFFFFFFFFFFFFFFF
            extra[x] = (total ^ (0xA5A5A5A5 * int(count[r]))) & 0xFFFFFFFFFFFFFFFF
        full, rows = np.concatenate([full, B.mix(extra)]), np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        full, rows = full[order], rows[order]
    return full, rows


def sets(data: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each row."""
    h, row = shingle_hashes(data, off, k)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return np.split(h[new], np.searchsorted(row[new], np.arange(1, len(off) - 1)))


def signatures(batches, bands: int, k: int):
    """Per row: size of the set, a digest of the set, the minima. Of equal sets of a task only the first carries minima."""
    a, b = coefficients(bands * ROWS)
    seen: set[bytes] = set()
    for batch in batches:
        for i, j, data, off in text_steps(batch.column("text")):
            own = sets(data, off, k)
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else b"" for s in own]
            first = []
            for r, d in enumerate(digest):
                if d and d not in seen:
                    seen.add(d)
                    first.append(r)
            sig = [None] * (j - i)
            if first:
                size = [len(own[r]) for r in first]
                begin = np.concatenate(([0], np.cumsum(size)[:-1]))
                x = np.concatenate([own[r] for r in first]) >> np.uint64(32)
                low = np.empty((len(first), len(a)), np.uint32)
                for c in range(len(a)):
                    low[:, c] = np.minimum.reduceat((x * a[c] + b[c]) >> np.uint64(32), begin)
                for r, s in zip(first, packed(low, bands), strict=True):
                    sig[r] = s
            n = pa.array([len(s) for s in own], pa.int64())
            cols = [batch.column("doc_id").slice(i, j - i), batch.column("row_key").slice(i, j - i), n, pa.array(digest, pa.binary()), pa.array(sig, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row_key", "n_shingles", "digest", "sig"])


def packed(low: np.ndarray, bands: int) -> np.ndarray:
    """A long for each band: the low bits of its four minima, 15 of 16 (the last 14). Equal longs in one place are a shared bucket."""
    four = (low.reshape(len(low), bands, ROWS) & np.array([0x7FFF, 0x7FFF, 0x7FFF, 0x3FFF], np.uint32)).astype(np.uint64)
    long = four[:, :, 0] | four[:, :, 1] << np.uint64(16) | four[:, :, 2] << np.uint64(32) | four[:, :, 3] << np.uint64(48)
    return long.view(np.int64)


def agreeing(a: list, b: list) -> F.Column:
    """How many minima two signatures share: all lanes but those that differ."""
    total = F.lit(ROWS * len(a))
    for x, y in zip(a, b, strict=True):  # a lane that differs carries into the free bit above it
        total = total - F.bit_count((x.bitwiseXOR(y) + F.lit(0x3FFF7FFF7FFF7FFF)).bitwiseAND(F.lit(0x4000800080008000)))
    return total


def alike(pairs: DataFrame, nodes: DataFrame, bands: int, percent: int, floor: float) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a link."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"{side}_size"), F.col("sig").alias(f"{side}_sig")), side)
    a, b = ([F.col(f"{side}_sig")[j] for j in range(bands)] for side in ("a", "b"))
    sizes = 100 * F.least("a_size", "b_size") >= percent * F.greatest("a_size", "b_size")
    return pairs.where(sizes & (agreeing(a, b) >= int(floor * bands * ROWS))).select("a", "b")


def confirmed(batches, k: int, percent: int):
    """(a, b) of rows ``b, other, text``, sorted: the hub itself first (other is null), then those whose sets are held against its set."""
    hub, hub_set = None, None
    for batch in batches:
        found = ([], [])
        for i, j, data, off in text_steps(batch.column("text")):
            names = zip(batch.column("b").slice(i, j - i).to_pylist(), batch.column("other").slice(i, j - i).to_pylist(), sets(data, off, k), strict=True)
            for b, other, own in names:
                if other is None:
                    hub, hub_set = b, own
                    continue
                if b != hub:
                    raise ValueError(f"no text of node {b} before the pairs of it")
                at = np.minimum(np.searchsorted(hub_set, own), len(hub_set) - 1)
                both = int((hub_set[at] == own).sum())
                if both and 100 * both >= percent * (len(own) + len(hub_set) - both):
                    found[0].append(other)
                    found[1].append(b)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])


def texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the text of each row's row_key."""
    if small_enough(wanted, BROADCAST_IDS):
        wanted = F.broadcast(wanted)
    return docs.select("row_key", "text").join(wanted, "row_key").drop("row_key")


def linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of candidate pairs (a, b) those whose full sets are similar enough. Texts travel once for each pair, those of b once for HUB_PAIRS pairs."""
    pairs = cut(pairs)
    shares = pairs.groupBy("b").agg(F.ceil(F.count("*") / HUB_PAIRS).cast("int").alias("shares"))
    key = classes.select("node", "row_key")
    hubs = shares.join(key.withColumnRenamed("node", "b"), "b")
    hubs = hubs.select("row_key", "b", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(None).cast("long").alias("other"))
    rest = pairs.join(shares, "b").join(key.withColumnRenamed("node", "a"), "a")
    rest = rest.select("row_key", "b", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("share"), F.col("a").alias("other"))
    rows = texts(docs, cut(hubs.union(rest)))
    rows = rows.repartition("b", "share").sortWithinPartitions("b", "share", F.col("other").asc_nulls_first())
    return per_batch(rows.select("b", "other", "text"), lambda it: confirmed(it, k, percent), "a long, b long").distinct()


def components(edges: DataFrame, most: int = 50) -> DataFrame:
    """(node, comp) of every node that has an edge (a, b): alternating large-star and small-star until nothing changes."""
    both = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = tuple(both.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    if not seen[0]:
        return both.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    for _ in range(most):
        sym = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = join_skewed(sym.where("v > u"), low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large)  # every edge points from a node to a smaller one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_skewed(large, low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after = cut(small.where("u <> v").distinct())
        now = tuple(after.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        same, seen = now == seen, now
        both = after
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return both.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(both.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def counted(batches, k: int):
    """(token, n): in how many texts of a step each shingle is."""
    for batch in batches:
        for _, _, data, off in text_steps(batch.column("text")):
            token, n = np.unique(np.concatenate(sets(data, off, k)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], names=["token", "n"])


def prefixes(batches, k: int, percent: int, common: tuple[np.ndarray, np.ndarray]):
    """The first shingles of each text, rarest first: so many that a similar set has one of them among its own."""
    many, count = common
    for batch in batches:
        for i, j, data, off in text_steps(batch.column("text")):
            row, token, place, size = [], [], [], []
            for r, own in enumerate(sets(data, off, k)):
                n = len(own)
                rank = np.zeros(n, np.int64)
                if len(many):
                    at = np.minimum(np.searchsorted(many, own), len(many) - 1)
                    rank = np.where(many[at] == own, count[at], 0)
                keep = n - -(-percent * n // 100) + 1
                token.append(own[np.lexsort((own, rank))[:keep]])
                row.append(np.full(keep, r))
                place.append(np.arange(keep))
                size.append(np.full(keep, n))
            at = pa.array(np.concatenate(row) + i)
            names = ("node", "comp", "rest")
            cols = [batch.column(c).take(at) for c in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(token).view(np.int64)), *cols, pa.array(np.concatenate(place).astype(np.int32)), pa.array(np.concatenate(size).astype(np.int32))],
                names=["token", *names, "place", "size"],
            )


def common_shingles(open_texts: DataFrame, k: int, common: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of more than ``common`` texts and their number of texts, sorted; at most ``most``, the most common ones."""
    tokens = per_batch(open_texts.select("text"), lambda it: counted(it, k), "token long, n long")
    tokens = cut(tokens.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > common))
    while not small_enough(tokens, most):
        common *= 2
        tokens = tokens.where(F.col("n") > common)
    got = tokens.toArrow()
    token, n = got.column("token").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


def cross_pairs(open_nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes (node, comp, rest) in different components, a among the rest, that can be similar enough by their first shingles."""
    spark = docs.sparkSession
    found = texts(docs, cut(open_nodes.join(classes.select("node", "row_key"), "node")))
    sent = spark.sparkContext.broadcast(common_shingles(found, k, COMMON, MOST_COMMON))
    first = per_batch(found.select("node", "comp", "rest", "text"), lambda it: prefixes(it, k, percent, sent.value), "token long, node long, comp long, rest boolean, place int, size int")
    first = stored(first, "prefix")
    sent.unpersist()
    left, right = ([F.col(c).alias(f"{c}_{side}") for c in ("token", "node", "comp", "rest", "place", "size")] for side in ("a", "b"))
    pairs = first.where("rest").select(*left).join(
        first.select(*right).hint("merge"),
        F.expr("token_a = token_b and comp_a <> comp_b and (not rest_b or node_a < node_b)")
        & (100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
        & ((100 + percent) * F.least(F.expr("size_a - place_a"), F.expr("size_b - place_b")) >= percent * (F.col("size_a") + F.col("size_b"))),
    )
    return pairs.select(F.col("node_b").alias("a"), F.col("node_a").alias("b")).distinct()


def bucket_stars(nodes: DataFrame, bands: int) -> tuple[DataFrame, DataFrame]:
    """(held, star): the shared buckets of each node that has any, and its pairs (a, b) with their most central nodes."""
    member = nodes.select("node", F.posexplode("sig").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    held = join_skewed(member, shared, "bucket").groupBy("node").agg(F.collect_list("bucket").alias("buckets"), F.sum("n").alias("score"))
    held = cut(held)  # at most one bucket for each band
    each = held.select("node", "score", F.explode("buckets").alias("bucket"))
    central = each.groupBy("bucket").agg(F.max(F.struct("score", "node"))["node"].alias("b"))
    star = join_skewed(each.select(F.col("node").alias("a"), "bucket"), central, "bucket").where("a <> b").select("a", "b").distinct()
    return held, cut(star)


def open_nodes(held: DataFrame, comp: DataFrame) -> DataFrame:
    """(node, comp, rest) of nodes in buckets with several components; rest: outside the main component of one of these."""
    each = held.join(comp, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"), F.explode("buckets").alias("bucket"))
    each = cut(each)
    size = each.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    mixed = size.groupBy("bucket").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.count("*").alias("k")).where("k > 1").select("bucket", "main")
    return cut(join_skewed(each, mixed, "bucket").groupBy("node", "comp").agg(F.max(F.expr("comp <> main")).alias("rest")))


def joined(full: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int, bands: int, floor: float) -> DataFrame:
    """(node, comp) of all classes."""
    keys = ["row_key", "digest"]
    nodes = full.join(classes.select(*keys, "node"), keys).dropDuplicates(keys).select("node", "n_shingles", "sig")
    nodes = stored(nodes, "nodes")
    held, star = bucket_stars(nodes, bands)
    star = linked(alike(star, nodes, bands, percent, floor), classes, docs, k, percent)
    comp = cut(components(star))
    left = open_nodes(held, comp)
    more = cross_pairs(left, classes, docs, k, percent)
    more = linked(alike(more, nodes, bands, percent, floor), classes, docs, k, percent)
    for side in ("a", "b"):
        more = more.join(left.select(F.col("node").alias(side), F.col("comp").alias(f"comp_{side}")), side)
    over = components(more.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
    named = classes.select("node").join(comp, "node", "left").select("node", F.coalesce("comp", "node").alias("old"))
    over = over.select(F.col("node").alias("old"), F.col("comp").alias("new"))
    return join_skewed(named, over, "old", "left").select("node", F.coalesce("new", "old").alias("comp"))


def near_dup(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, floor: float = SIGNATURE_FLOOR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    rows = per_batch(docs, lambda it: signatures(it, bands, shingle), "doc_id long, row_key long, n_shingles long, digest binary, sig array<long>")
    with passing(docs.sparkSession) as keep:
        rows = stored(rows, "minhash")
        full = rows.where("n_shingles > 0")
        lead = F.min(F.when(F.col("sig").isNotNull(), F.col("row_key"))).alias("row_key")
        classes = full.groupBy("digest").agg(F.min("doc_id").alias("first_id"), lead)
        classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))
        named = joined(full.where("sig is not null"), classes, docs, shingle, percent, bands, floor).join(classes, "node")
        named = cut(named.select("digest", "comp", "first_id"))
        home = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
        named = keep(join_skewed(named, home, "comp").select("digest", "component_id"), "near_components")
        rows = keep(rows.select("doc_id", "n_shingles", "digest"), "near_rows")
    out = join_skewed(rows, named, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
