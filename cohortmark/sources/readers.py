"""Readers: every format becomes a flat table by Spark's own readers and expressions; reports are read by the folder."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortmark.functions.sequence import filestem
from cohortmark.operators import places, tiles
from cohortmark.operators.manifest import FIELDS
from cohortmark.operators.sequences import sized
from cohortmark.operators.storage import ship

PRIMER_FIELDS = ["name string", "size long"] + [f"{arm}_{k}" for arm in ("forward", "reverse", "internal") for k in ("seq string", "start long", "length long", "tm double", "gc double")] + ["source string", "sourcename string"]
PRIMER_SCHEMA = ", ".join(PRIMER_FIELDS)
BLAST_SCHEMA = "query string, subject string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart long, send long, evalue double, bitscore double"
AMPLIMER = "struct<_fwd:array<string>,_rev:array<string>,_len:long,_name:string,_seqname:string,primer_name:string,target:string,target_fasta_id:string>"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and their place in it (``ord``), however files are split."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = rows.withColumn("i", F.monotonically_increasing_id())
    return rows.withColumn("ord", F.struct("block", "i")).drop("block", "i")


def numbered(rows: DataFrame, **of_file: Callable[[Column], Column]) -> DataFrame:
    """Rows of text files (``file``, ``block``: where the split that they come from begins) with ``ord``, their place in the file from 0, and columns that follow
    from ``file``, made once for each split. Only counts of the splits are exchanged, no row."""
    rows = rows.withColumn("__i", F.monotonically_increasing_id())
    each = rows.groupBy(F.col("file").alias("__f"), F.col("block").alias("__b")).agg(F.min("__i").alias("__lo"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__f").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))  # a row for each split
    each = each.withColumn("__base", F.coalesce(before, F.lit(0))).withColumns({name: c(F.col("__f")) for name, c in of_file.items()})
    rows = rows.join(sized(each), (F.col("file") == F.col("__f")) & (F.col("block") == F.col("__b")))
    return rows.withColumn("ord", F.col("__base") + F.col("__i") - F.col("__lo")).drop("__f", "__b", "__lo", "__n", "__base", "__i")


def _checked(ok: Column, value: Column, message: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(message)).cast("string"))


def scan_manifest_tab(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated manifest: name, labels, sequence file and optionally features. Comments and empty lines are skipped, ``-`` is null;
    any other number of columns raises. Of repeated names the last row stays."""
    rows = lines(spark, path).where(~F.col("value").startswith("#") & (F.trim("value") != "")).withColumn("c", F.split("value", "\t"))
    cell = lambda i: F.nullif(F.get("c", F.lit(i)), F.lit("-"))
    name = _checked(F.size("c").isin(3, 4), F.get("c", F.lit(0)), "a manifest row needs 3 or 4 columns")
    rows = rows.select(name.alias("name"), F.array_sort(F.array_distinct(F.transform(F.split(F.get("c", F.lit(1)), ","), lambda x: F.trim(x)))).alias("groups"), cell(2).alias("seqfile"), cell(3).alias("features"), "ord")
    last = Window.partitionBy("name").orderBy(F.col("ord").desc())
    rows = rows.withColumn("n", F.row_number().over(last)).where("n = 1")
    missing = [F.lit(None).cast("string").alias(c) for c in ("filtered_seqfile", "primers", "primersearch", "target_amplicons")]
    return rows.select("*", *missing, filestem(F.col("seqfile")).alias("filestem")).select(*FIELDS)


def scan_manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON manifest: an array of objects. A required key that no object has raises at once, one that some lack when read."""
    required = ("name", "groups", "seqfile", "features", "primers", "target_amplicons")
    keys = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<map<string,string>>")).alias("m")).select(F.map_keys("m").alias("k"))
    bad = keys.where(F.size(F.array_except(F.array(*map(F.lit, required)), "k")) > 0)
    if not bad.isEmpty():
        raise ValueError(f"manifest objects need the keys {', '.join(required)}")
    schema = "name string, groups array<string>, " + ", ".join(f"{c} string" for c in FIELDS[2:])
    rows = spark.read.schema(schema).json(path, multiLine=True)
    return rows.withColumn("groups", F.array_sort("groups")).withColumn("filestem", F.coalesce("filestem", filestem(F.col("seqfile")))).select(*FIELDS)


def scan_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, seq_id, description, ord, seq) of each record; records end where the next header begins, so files may be split."""
    rows = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = numbered(rows.withColumn("value", F.regexp_replace("value", "^[\\s>]+", "")).where("value <> ''"))
    head = F.substring_index("value", "\n", 1)
    body = F.when(F.col("value").contains("\n"), F.expr("substring(value, length(substring_index(value, '\n', 1)) + 2)")).otherwise("")
    return rows.select("file", filestem(F.col("file")).alias("name"), F.regexp_extract(head, r"^(\S*)", 1).alias("seq_id"), F.trim(F.regexp_replace(head, "\r", "")).alias("description"), F.col("ord").cast("int").alias("ord"), F.regexp_replace(body, r"\s", "").alias("seq"))


def scan_fasta_tiles(spark: SparkSession, path: str, size: int = tiles.SIZE) -> DataFrame:
    """(name, seq_id, description, ord, tile, seq): records of any length as tiles, from their lines. Each split joins its lines to stretches of records; only what a split
    leaves open (its records, the bases since the last one began, that one's title: a row for each split) goes on to the next."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = rows.withColumn("value", F.trim(F.regexp_replace("value", "\r", ""))).where("value <> ''")
    head = F.col("value").startswith(">")
    rows = rows.select("file", "block", F.when(head, F.expr("substring(value, 2)")).alias("title"), F.when(head, "").otherwise(F.regexp_replace("value", r"\s", "")).alias("seq"))
    found, ends = _stretches(rows, False), _stretches(rows, True)
    order = Window.partitionBy("file").orderBy("block")
    upto, past = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("upto", F.sum("heads").over(upto)).withColumn("left", F.sum("at").over(Window.partitionBy("file", "upto").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.select(
        F.col("file").alias("__f"), F.col("block").alias("__b"), (F.col("upto") - F.col("heads")).alias("before"),
        F.coalesce(F.lag("left").over(order), F.lit(0)).alias("left"), F.last("title", ignorenulls=True).over(past).alias("open"),
    )
    rows = found.join(sized(ends), (F.col("file") == F.col("__f")) & (F.col("block") == F.col("__b")))
    at = F.col("at") + F.when(F.col("heads") == 0, F.col("left")).otherwise(0)
    rows = rows.select("file", (F.col("before") + F.col("heads") - 1).alias("record"), F.coalesce("title", "open").alias("title"), at.alias("at"), "seq").where("record >= 0")
    rows = rows.select(filestem(F.col("file")).alias("name"), F.regexp_extract("title", r"^\s*(\S*)", 1).alias("seq_id"), F.trim("title").alias("description"), F.col("record").cast("int").alias("ord"), "at", "seq")
    return tiles.laid(rows, ["name", "seq_id", "description", "ord"], size)


def _stretches(rows: DataFrame, ends: bool) -> DataFrame:
    """(file, block, heads, at, title, seq) of lines (file, block, title, seq) in the order of their splits: the lines of one record that stand together, ``heads`` records
    having begun in the split, the last of them ``title``, ``at`` bases before (null and the bases since the split's begin, if none has). With ``ends`` the state at the
    end of each split instead."""
    ship(rows.sparkSession)
    names = ["file", "block", "heads", "at", "title", "seq"]

    def step(batches):
        file = block = None
        heads, at, title, out = 0, 0, None, []

        def batched():
            cols = zip(*out, strict=True) if out else [[]] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(cols, kinds, strict=True)], names=names)

        for whole in batches:
            for batch in places.slices(whole):
                c, begin = places.points(batch.column("seq"))
                text = c.tobytes().decode("ascii" if c.dtype == np.uint8 else "utf-32-le")
                head = batch.column("title").is_valid().to_numpy(zero_copy_only=False)
                files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
                which = files.indices.to_numpy()
                new = np.concatenate(([True], (which[1:] != which[:-1]) | (blocks[1:] != blocks[:-1])))
                cuts = np.flatnonzero(new | head)
                for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows], strict=True):
                    if new[x]:
                        own = files.dictionary[int(which[x])].as_py(), int(blocks[x])
                        if own != (file, block):
                            if ends and file is not None:
                                out.append((file, block, heads, at, title, None))
                            (file, block), heads, at, title = own, 0, 0, None
                    if head[x]:
                        heads, at, title = heads + 1, 0, batch.column("title")[x].as_py()
                    if not ends:
                        out.append((file, block, heads, at, title, text[begin[x] : begin[y]]))
                    at += int(begin[y] - begin[x])
                if not ends:
                    yield batched()
                    out.clear()
        if ends:
            if file is not None:
                out.append((file, block, heads, at, title, None))
            yield batched()

    return rows.mapInArrow(step, "file string, block long, heads long, at long, title string, seq string")


def load_fasta_ids(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq_id) of the first record of each file."""
    return scan_fasta(spark, path).where("ord = 0").select("file", "seq_id")


def scan_alignment_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Aligned records; rows of different lengths in one file raise when read."""
    rows = scan_fasta(spark, path)
    w = Window.partitionBy("file")
    same = F.min(F.length("seq")).over(w) == F.max(F.length("seq")).over(w)
    return rows.withColumn("seq", _checked(same, F.col("seq"), "aligned rows differ in length"))


def scan_primers(spark: SparkSession, path: str, fmt: str = "eprimer3", noname: bool = False) -> DataFrame:
    if fmt in ("ep3", "eprimer3"):
        return scan_primers_eprimer3(spark, path, noname)
    if fmt in ("p3", "primer3"):
        return scan_primers_primer3(spark, path)
    if fmt == "json":
        return scan_primers_json(spark, path)
    raise ValueError(f"unknown primer format {fmt}")


def scan_primers_json(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of JSON files that hold an array of objects, or an object on each line."""
    kind = ",".join(f"{n}:{t}" for n, t in (f.split() for f in PRIMER_FIELDS))
    text = F.col("value")
    rows = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    one = F.from_json(text, f"array<struct<{kind}>>")
    many = F.from_json(F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]")), f"array<struct<{kind}>>")
    return _whole(spark, path).select(F.explode(F.when(text.rlike(r"^\s*\["), one).otherwise(many)).alias("p")).select("p.*")


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))


def scan_primers_eprimer3(spark: SparkSession, path: str, noname: bool = False) -> DataFrame:
    """Pairs of design reports. Unless ``noname``, names are made from file and place; else they are those of the comment lines."""
    rows = spark.read.option("lineSep", "PRODUCT SIZE:").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = numbered(rows).select("file", F.col("ord").cast("int").alias("i"), F.col("value").alias("block"))
    if noname:  # the name stands at the end of the block before
        given = F.regexp_extract("block", r"#\s*(\S+)\s*\n\s*\d+\s*$", 1)
        before = rows.select(F.col("file").alias("__f"), (F.col("i") + 1).alias("__i"), given.alias("given"))
        rows = rows.where("i > 0").join(before.hint("merge"), (F.col("file") == F.col("__f")) & (F.col("i") == F.col("__i")))
    else:
        rows = rows.where("i > 0").withColumn("given", F.lit(""))
    given = F.col("given")
    made = F.format_string("%s_primer_%05d", filestem(F.col("file")), F.col("i"))
    cols = [(F.nullif(given, F.lit("")) if noname else made).alias("name"), F.regexp_extract("block", r"^\s*(\d+)", 1).cast("long").alias("size")]
    for arm, label in (("forward", "FORWARD PRIMER"), ("reverse", "REVERSE PRIMER"), ("internal", "INTERNAL OLIGO")):
        pattern = label + r"[ \t]+(\d+)[ \t]+(\d+)[ \t]+([\d.]+)[ \t]+([\d.]+)[ \t]*([A-Za-z]*)"
        take = lambda g, p=pattern: F.regexp_extract("block", p, g)
        num = lambda g, t, p=pattern: F.coalesce(F.nullif(F.regexp_extract("block", p, g), F.lit("")).cast(t), F.lit(0).cast(t))
        cols += [take(5).alias(f"{arm}_seq"), num(1, "long").alias(f"{arm}_start"), num(2, "long").alias(f"{arm}_length"), num(3, "double").alias(f"{arm}_tm"), num(4, "double").alias(f"{arm}_gc")]
    return rows.select(*cols, F.col("file").alias("source"), filestem(F.col("file")).alias("sourcename"))


def scan_primers_primer3(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of key=value design output up to the line ``=``; a file without pairs has no rows."""
    rows = spark.read.text(path).select(F.regexp_replace("value", "\r", "").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = numbered(rows)
    last = rows.where(F.col("value").startswith("=") & (F.col("ord") > 0)).groupBy(F.col("file").alias("__f")).agg(F.min("ord").alias("end"))  # a row for each file
    rows = rows.join(sized(last), F.col("file") == F.col("__f"), "left").where("end is null or ord < end")
    label = F.substring_index("value", "=", 1)
    rows = rows.select("file", F.regexp_extract(label, r"^PRIMER_(?:PAIR|LEFT|RIGHT)_(\d+)(?:_[A-Z_]+)?$", 1).alias("i"), F.regexp_replace(label, r"_\d+", "").alias("key"), F.expr("substring(value, length(substring_index(value, '=', 1)) + 2)").alias("text"))
    taken = ["PRIMER_PAIR_PENALTY", "PRIMER_PAIR_PRODUCT_SIZE"] + [f"PRIMER_{x}{y}" for x in ("LEFT", "RIGHT") for y in ("", "_SEQUENCE", "_TM", "_GC_PERCENT")]
    rows = rows.where(F.col("i") != "").groupBy("file", F.col("i").cast("int").alias("i")).agg(*[F.max(F.when(F.col("key") == x, F.col("text"))).alias(x) for x in taken]).where("PRIMER_PAIR_PENALTY is not null")
    key = lambda form: F.col(form.replace("_%d", ""))
    cols = [F.format_string("%s_primer_%05d", filestem(F.col("file")), F.col("i") + 1).alias("name"), key("PRIMER_PAIR_%d_PRODUCT_SIZE").cast("long").alias("size")]
    for arm, label in (("forward", "LEFT"), ("reverse", "RIGHT")):
        place = F.split(key(f"PRIMER_{label}_%d"), ",")
        cols += [key(f"PRIMER_{label}_%d_SEQUENCE").alias(f"{arm}_seq"), place[0].cast("long").alias(f"{arm}_start"), place[1].cast("long").alias(f"{arm}_length"), key(f"PRIMER_{label}_%d_TM").cast("double").alias(f"{arm}_tm"), key(f"PRIMER_{label}_%d_GC_PERCENT").cast("double").alias(f"{arm}_gc")]
    cols += [F.lit("").alias("internal_seq"), F.lit(0).cast("long").alias("internal_start"), F.lit(0).cast("long").alias("internal_length"), F.lit(0.0).alias("internal_tm"), F.lit(0.0).alias("internal_gc")]
    return rows.select(*cols, F.col("file").alias("source"), filestem(F.col("file")).alias("sourcename"))


def scan_primersearch_report(spark: SparkSession, path: str, lengths: DataFrame | None = None) -> DataFrame:
    """Amplimers of search reports named <query>_ps_<target>, files or folders of parts. With ``lengths`` (target, target_length) the reverse primer's
    coordinates on the forward strand come too."""
    named = lambda g: lambda file: F.regexp_extract(file, r"([^/=]+)_ps_([^/]+?)(\.[^/.]+)?(/part-[^/]*)?$", g)
    rows = spark.read.option("lineSep", "Primer name ").text(path).select(F.col("value").alias("record"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = numbered(rows, query=named(1), target=named(2)).where("ord > 0")
    rows = rows.select("query", "target", F.regexp_extract("record", r"^(\S+)", 1).alias("primer_name"), F.posexplode(F.split("record", r"(?m)^\s*Amplimer (?=\d)")).alias("i", "hit")).where("i > 0")
    # a line's words: sequence, hits, strand's name, strand, at, place, with, number, mismatches; looked for at beginnings of words only
    words = lambda which: F.split(F.regexp_extract("hit", rf"(?<!\S)\S++ hits {which} strand at \[?\d+\]? with \d+ mismatches", 0), " ")
    word = lambda line, i: F.translate(F.coalesce(F.get(line, F.lit(i)), F.lit("")), "[]", "")
    rows = rows.withColumns({"fwd": words("forward"), "rev": words("reverse")})
    out = rows.select(
        "query", "target", "primer_name", F.col("i").alias("idx"),
        F.concat(F.lit("Amplimer "), F.regexp_extract("hit", r"^(\d+)", 1)).alias("amplimer"), F.regexp_extract("hit", r"Sequence: (\S+)", 1).alias("sequence"),
        F.get("fwd", F.lit(0)).alias("fwd_seq"), word("fwd", 5).cast("long").alias("fwd_start"), word("fwd", 7).cast("int").alias("fwd_mismatches"),
        F.get("rev", F.lit(0)).alias("rev_seq"), word("rev", 5).cast("long").alias("rev_pos"), word("rev", 7).cast("int").alias("rev_mismatches"),
        F.regexp_extract("hit", r"Amplimer length: (\d+)", 1).cast("long").alias("length"),
    ).withColumn("fwd_end", F.col("fwd_start") + F.length("fwd_seq"))
    if lengths is not None:
        out = out.join(sized(lengths), "target").withColumn("rev_end", F.col("target_length") - F.col("rev_pos") + 1)
        out = out.withColumn("rev_start", F.col("rev_end") - F.length("rev_seq")).drop("target_length")
    return out


def scan_target_amplicons_json(spark: SparkSession, path: str) -> DataFrame:
    """Amplimers of JSON files that map targets to lists of amplimers."""
    return amplicon_rows(_whole(spark, path))


def amplicon_rows(texts: DataFrame) -> DataFrame:
    """Amplimers of JSON texts (``value``)."""
    rows = texts.select(F.explode(F.from_json("value", f"map<string,array<{AMPLIMER}>>")).alias("key", "list")).select("key", F.posexplode("list").alias("i", "a"))
    arm = lambda c: F.struct(F.get(c, F.lit(0)).alias("seq"), F.get(c, F.lit(1)).cast("long").alias("start"), F.get(c, F.lit(2)).cast("long").alias("end"))
    return rows.select(F.col("key").alias("target"), F.col("a.primer_name").alias("primer_name"), F.col("a._name").alias("amplimer"), F.col("a._seqname").alias("sequence"), F.col("a._len").alias("length"), F.col("a.target").alias("target_file"), F.col("a.target_fasta_id").alias("target_fasta_id"), arm(F.col("a._fwd")).alias("fwd"), arm(F.col("a._rev")).alias("rev"))


def scan_primersearch_index(spark: SparkSession, path: str) -> DataFrame:
    """(query_file, target, report) of index files; the entries about the query itself are left out."""
    rows = _whole(spark, path).select("file", F.explode(F.from_json("value", "map<string,string>")).alias("target", "report"))
    return rows.where(~F.col("target").isin("primers", "query")).select(F.col("file").alias("query_file"), "target", "report")


def scan_blast_hits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLAST_SCHEMA).csv(path, sep="\t")


def scan_delta_intervals(spark: SparkSession, path: str, min_sim_errors: int = 0, min_err_rate: float = 0.0) -> DataFrame:
    """(query, subject, start, end, sim_errors) of alignment files: rows of seven numbers; names are those of the files in line one."""
    rows = scan_delta_lines(spark, path).where("kind = 'row'")
    from cohortmark.operators.intervals import alignment_quality_filter

    number = lambda i: F.get("c", F.lit(i)).try_cast("long")  # noqa: E731  (filters may be tried in any order)
    out = rows.select("query", "subject", number(0).alias("start"), number(1).alias("end"), number(5).alias("sim_errors"))
    return alignment_quality_filter(out, min_sim_errors, min_err_rate)


def scan_delta_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of alignment files with their kind (paths, program, header, row, indel) and record numbers. What should be a number and is none is read as null.

    Lines are counted within the split that they come from; counts of the splits before it are added (a row for each split), so a file is as many tasks as it has splits.
    """
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = numbered(rows).withColumn("n", F.col("ord") + 1).withColumn("c", F.split(F.trim("value"), "\\s+"))
    kind = F.when(F.col("n") == 1, "paths").when(F.col("n") == 2, "program").when(F.col("value").startswith(">"), "header").when(F.size("c") == 7, "row").otherwise("indel")
    rows = rows.withColumn("kind", kind)
    kinds, sums = ("header", "row"), lambda k: F.sum((F.col("kind") == k).cast("int"))
    each = rows.groupBy(F.col("file").alias("__f"), F.col("block").alias("__b")).agg(*[sums(k).alias(f"__{k}") for k in kinds])
    splits = Window.partitionBy("__f").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("__f", "__b", *[F.coalesce(F.sum(f"__{k}").over(splits), F.lit(0)).alias(f"__{k}") for k in kinds])
    run = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"{k}_no": sums(k).over(run) for k in kinds})
    rows = rows.join(sized(each), (F.col("file") == F.col("__f")) & (F.col("block") == F.col("__b")))
    rows = rows.withColumns({f"{k}_no": F.col(f"{k}_no") + F.col(f"__{k}") for k in kinds}).drop("__f", "__b", *[f"__{k}" for k in kinds])
    first = rows.where("kind = 'paths'").select(F.col("file").alias("__f"), F.col("c").alias("paths"))
    rows = rows.join(sized(first), F.col("file") == F.col("__f"), "left").drop("__f", "block")
    return rows.withColumn("query", filestem(F.get("paths", F.lit(0)))).withColumn("subject", filestem(F.get("paths", F.lit(1))))


def scan_delta_full(spark: SparkSession, path: str) -> DataFrame:
    """One row for each alignment: program, ref, qry, lengths, the seven numbers, and its indels in order, without the final 0."""
    rows = scan_delta_lines(spark, path)
    field = lambda i: F.get("c", F.lit(i))
    length = lambda i: field(i).try_cast("long")
    heads = rows.where("kind = 'header'").select("file", "header_no", F.substring(field(0), 2, 1_000_000).alias("ref"), field(1).alias("qry"), length(2).alias("ref_length"), length(3).alias("qry_length"))
    program = rows.where("kind = 'program'").select("file", F.col("value").alias("program"))
    names = ("ref_start", "ref_end", "qry_start", "qry_end", "errors", "sim_errors", "stops")
    aligned = rows.where("kind = 'row'").select("file", "query", "subject", "header_no", "row_no", *[F.get("c", F.lit(i)).try_cast("long").alias(x) for i, x in enumerate(names)])
    indels = rows.where("kind = 'indel' and row_no > 0 and value <> '0' and trim(value) <> ''").groupBy("file", "row_no").agg(F.array_sort(F.collect_list(F.struct("n", F.col("value").try_cast("long").alias("v")))).alias("x"))
    out = aligned.join(heads, ["file", "header_no"]).join(program, "file", "left").join(indels, ["file", "row_no"], "left")
    return out.withColumn("indels", F.coalesce(F.transform("x", lambda x: x["v"]), F.array().cast("array<bigint>"))).drop("x")


def delta_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: whether two tables of alignments agree, whatever their files and order."""
    cols = ["ref", "qry", "ref_length", "qry_length", "ref_start", "ref_end", "qry_start", "qry_end"]
    x, y = a.select(*cols), b.select(*cols)
    return x.exceptAll(y).union(y.exceptAll(x)).agg((F.count("*") == 0).alias("equal"))


def scan_features(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """(chrom, start, end, ord) of GFF or BED files, from 0 and half open."""
    fmt = fmt or ("bed" if path.lower().rstrip("*").endswith("bed") else "gff")
    rows = lines(spark, path).where(~F.col("value").startswith("#") & F.col("value").contains("\t")).withColumn("c", F.split("value", "\t"))
    at = (1, 2, 0) if fmt == "bed" else (3, 4, 1)
    return rows.select(F.col("c")[0].alias("chrom"), (F.col("c")[at[0]].cast("long") - at[2]).alias("start"), F.col("c")[at[1]].cast("long").alias("end"), "ord")


#: The columns of distance tables that are no text.
DISTANCES = {"dist_mean": "double", "dist_sd": "double", "dist_min": "double", "dist_max": "double", "unique": "int", "nonunique": "int", "shannon_index": "double", "shannon_evenness": "double"}


def scan_distance_table(spark: SparkSession, path: str) -> DataFrame:
    """Distance tables by the names in their header; only that line is looked at for the schema."""
    rows = spark.read.csv(path, header=True, sep="\t")
    return rows.select(*[F.col(c).cast(DISTANCES.get(c, "string")).alias(c) for c in rows.columns])
