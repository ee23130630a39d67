"""Mixing sources to target weights.

Each source's words stand in one fixed order (a hash of the document, then doc_id) and are packed into blocks of a fixed number of
words. The mix has as many slots as all words fill blocks; each source's number is fixed by its target, and the slots are dealt to output shards by one pseudorandom
permutation of all of them. So the number of slots that a source gets in a shard is a multinomial draw, conditioned on the sources' totals: shards differ as multinomial
draws do, and no source misses its target (draws without the condition leave a source of 100 slots 10 percent off). The slots of a source are numbered through; slot j
reads block perm_e(j mod blocks) of epoch e = j div blocks, where perm_e is a pseudorandom permutation of the source's block indexes. Slots and blocks
then meet in a join on (source, block).

A source gives at most ``MAX_REPEATS`` times its size; what its weight would ask beyond goes to the others by weight, so
``target`` is min(MAX_REPEATS * source_size, level * weight) with one common level. As no source has more slots than
MAX_REPEATS passes over its blocks, no document gives more than MAX_REPEATS times its size. All draws depend on the data and the
seed only: reruns agree.

Sizes count the words ``[^\\x20\\x09-\\x0D]+``; null and empty texts have size 0 and are in no block. A null source is a source of its own, last in
order. Repeated rows, rows without doc_id and rows that share one are rows of their own. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from . import bytescan as B
from .runtime import cut, free_names, passing, per_batch, quoted, ranked, text_steps

BLOCK_WORDS, SHARD_SLOTS, MAX_REPEATS, SEED = 128, 8192, 3, 11
#: Slots that one row makes.
SLOT_RUN = 1 << 16
#: Parts that a source's words are laid out in, each by a task of its own.
PARTS = 1024


def sizes(batches):
    for batch in batches:
        for i, j, data, off in text_steps(batch.column("text")):
            row = B.words(data, off)[2]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), batch.column("source").slice(i, j - i), pa.array(np.bincount(row, minlength=j - i).astype(np.int64))], names=["doc_id", "source", "size"])


def targets(by_source: DataFrame, weights=(1, 2, 3), most: int = MAX_REPEATS) -> DataFrame:
    """source, source_id, source_size, weight, target. ``by_source`` has a row for each source (source, source_size)."""
    rows = ranked(by_source, F.col("source").asc_nulls_last()).withColumnRenamed("rank", "source_id")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_id") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("weight", w).withColumn("cap", most * F.col("source_size"))
    size, weight = (x or 0 for x in rows.agg(F.sum("source_size"), F.sum("weight")).first())
    # Sources fill up in the order of cap / weight: with those before full, the level is what is left by the weight left.
    rows = ranked(rows, F.col("cap") / F.col("weight"), F.col("source_id"), cap_before="cap", weight_before="weight").drop("rank")
    rows = rows.withColumn("level", (F.lit(size) - F.col("cap_before")) / (F.lit(weight) - F.col("weight_before")))
    rows = rows.withColumn("full", F.col("level") * F.col("weight") > F.col("cap"))
    level = rows.where("not full").agg(F.max("level")).first()[0]
    target = F.col("cap").cast("double") if level is None else F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return rows.select("source", "source_id", "source_size", "weight", target.cast("double").alias("target"))


def laid_out(docs: DataFrame, parts: int) -> DataFrame:
    """Rows of size over 0 with ``first``: words of the source before the document."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")
    rows = docs.where("size > 0").withColumn("part", part)
    own = Window.partitionBy("source_id", "part").orderBy("doc_id", "uid").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("in_part", F.coalesce(F.sum("size").over(own), F.lit(0)))
    sums = docs.where("size > 0").withColumn("part", part).groupBy("source_id", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source_id", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, ["source_id", "part"]).withColumn("first", F.col("start") + F.col("in_part")).drop("part", "in_part", "start")


def permuted(index: np.ndarray, blocks: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0 .. blocks - 1 for each key: a four-round Feistel network on the next power of four,
    applied again to what falls beyond."""
    half = np.zeros(len(blocks), np.uint64)
    top = np.maximum(blocks.astype(np.int64) - 1, 0)
    while (big := (top >> (2 * half).astype(np.int64)) > 0).any():
        half[big] += np.uint64(1)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, h, m = out[todo], half[todo], mask[todo]
        left, right = x >> h, x & m
        for r in range(4):
            left, right = right, left ^ (B.mix(right + key[todo] * np.uint64(B.STEP) + np.uint64((r + 1) * B.BASE & (1 << 64) - 1)) & m)
        out[todo] = left << h | right
        todo = todo[out[todo] >= blocks[todo].astype(np.uint64)]
    return out.astype(np.int64)


def mapped(batches, slots: int, shard_slots: int, seed: int):
    """Slots with their shard and the block that each reads."""
    for batch in batches:
        slot, blocks, source, before = (batch.column(c).to_numpy() for c in ("slot", "blocks", "source_id", "before"))
        epoch = slot // blocks
        key = B.mix(source.astype(np.uint64) * np.uint64(1 << 20) + epoch.astype(np.uint64))
        block = permuted(slot % blocks, blocks, key)
        place = permuted(before + slot, np.full(len(slot), slots), np.full(len(slot), B.mix(np.array([seed], np.uint64))[0]))
        yield pa.RecordBatch.from_arrays([batch.column("source_id"), pa.array(place // shard_slots), batch.column("slot"), pa.array(epoch), pa.array(block)], names=["source_id", "shard", "slot", "epoch", "block"])


def dealt(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(source_id, shard, slot, epoch, block) of every slot. ``sources`` (source_id, blocks, total) has a row for each source."""
    rows = ranked(sources.select(F.col("source_id").cast("long").alias("source_id"), F.col("blocks").cast("long").alias("blocks"), F.col("total").cast("long").alias("total")), F.col("source_id"), before="total")
    rows = cut(rows.where("total > 0").drop("rank"))
    slots = rows.agg(F.sum("total")).first()[0] or 0
    run = rows.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / SLOT_RUN))))
    run = run.repartition(max(1, -(-slots // (4 * SLOT_RUN))), "source_id", "run")  # a hot source's slots are made by many tasks
    at = F.explode(F.sequence(F.col("run") * SLOT_RUN, F.least((F.col("run") + 1) * SLOT_RUN, "total") - 1)).alias("slot")
    slot = run.select("source_id", "blocks", F.col("before").cast("long").alias("before"), at)
    return per_batch(slot, lambda b: mapped(b, slots, shard_slots, seed), "source_id long, shard long, slot long, epoch long, block long")


def plan(docs: DataFrame, block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, most: int = MAX_REPEATS, seed: int = SEED, parts: int = PARTS, weights=(1, 2, 3)):
    """(rows, pieces): every row with its source's figures, and what the mix takes.

    ``pieces`` has uid, shard, slot, epoch, block, word_from, word_to: words [word_from, word_to) of a row, for each slot that reads them.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    rows = per_batch(docs, sizes, "doc_id long, source string, size long")
    rows = cut(rows.withColumn("uid", F.monotonically_increasing_id()))
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = targets(by_source, weights, most).withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    sources = cut(sources.withColumn("want", F.when(F.col("source_size") > 0, F.col("target") / (F.col("source_size") / F.col("blocks"))).otherwise(0.0)))
    sources = sources.withColumn("total", F.least(F.round("want").cast("long"), most * F.col("blocks")))
    named = rows.join(sources, rows["source"].eqNullSafe(sources["source"]), "left")
    named = cut(named.select(rows["doc_id"], "uid", rows["source"], "size", "source_id", "source_size", "target", "blocks"))
    if sources.where("total > 0").isEmpty():
        return named, None
    slot = dealt(sources, shard_slots, seed)
    held = laid_out(named, parts)
    held = held.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block))))
    word_from = F.greatest(F.lit(0), F.col("block") * block - F.col("first"))
    word_to = F.least(F.col("size"), (F.col("block") + 1) * block - F.col("first"))
    held = held.select("source_id", "block", "uid", word_from.alias("word_from"), word_to.alias("word_to"))
    # Spark cannot know how many slots the explosion makes and would broadcast them: never.
    pieces = held.join(slot.hint("merge"), ["source_id", "block"])
    return named, pieces


def cut_out(batches, columns: list[str], piece: str, whole: str):
    """A row for each epoch: the words that the mix takes, in text order; a document taken whole keeps its text as it is."""
    for batch in batches:
        index, texts = [], []
        for r, (text, pieces) in enumerate(zip(batch.column(whole).to_pylist(), batch.column(piece).to_pylist(), strict=True)):
            raw = (text or "").encode()
            data = np.frombuffer(raw, np.uint8)
            first, last, _ = B.words(data, np.array([0, len(data)]))
            by_epoch: dict[int, list] = {}
            for p in sorted((p["epoch"], p["word_from"], p["word_to"]) for p in pieces):
                own = by_epoch.setdefault(p[0], [])
                if own and own[-1][1] == p[1]:
                    own[-1][1] = p[2]
                else:
                    own.append([p[1], p[2]])
            for own in by_epoch.values():
                index.append(r)
                texts.append(text if own == [[0, len(first)]] else "\n".join(raw[first[a] : last[b - 1] + 1].decode() for a, b in own))
        rows = batch.take(pa.array(index, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else rows.column(c) for c in columns], names=columns)


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each document and epoch, holding the words taken. ``n_chars`` follows the text.

    Rows without doc_id, and rows that share one, are rows of their own: the mix then works on a written copy in which each row has a number. What it adds on the way
    has names that no column of ``docs`` has.
    """
    doc_id = F.col("doc_id").cast("long")
    key, piece, whole = free_names(docs, "row", "pieces", "whole")
    plain = docs.groupBy(doc_id.alias("id")).agg(F.count("*").alias("n")).where("id is null or n > 1").isEmpty()
    with passing(docs.sparkSession) as keep:
        rows = docs.withColumn(key, doc_id) if plain else keep(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
        named, pieces = plan(rows.select(F.col(key).alias("doc_id"), "source", "text"), **how)
        if pieces is None:
            return docs.limit(0)
        taken = pieces.select("uid", F.struct("epoch", "word_from", "word_to").alias("p")).join(named.select("uid", F.col("doc_id").alias(key)), "uid")
        taken = keep(taken.groupBy(key).agg(F.collect_list("p").alias(piece)), "pieces")
    both = rows.join(taken, key).select(F.col("text").cast("string").alias(whole), piece, *quoted(docs.columns))
    columns = [f"c{i}" if c != "text" else c for i, c in enumerate(docs.columns)]  # by place: mapInArrow takes no names with dots
    schema = StructType([StructField(c, f.dataType) for c, f in zip(columns, docs.schema, strict=True)])
    out = per_batch(both.toDF(whole, piece, *columns), lambda it: cut_out(it, columns, piece, whole), schema).toDF(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix(docs: DataFrame, **how) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of each row of ``docs`` (doc_id, source, text)."""
    with passing(docs.sparkSession) as keep:
        rows, pieces = plan(docs, **how)
        rows = keep(rows.select("uid", "doc_id", "source", "size", "source_size", "target"), "mix")
        if pieces is None:
            return rows.select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
        taken = keep(pieces.groupBy("uid").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken")), "taken")
    return rows.join(taken, "uid", "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
