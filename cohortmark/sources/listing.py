"""What earlier steps left: outputs below a folder as a table, complete ones told from empty and half-written ones, and the work that is still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmark.operators.manifest import SUFFIX


def files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, modified) of all files below ``path`` that have bytes. Contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.select("path", "length", F.col("modificationTime").alias("modified"))


def _output(path: Column) -> Column:
    """Name of the output that a file is or is a part of: parts lie in a folder, which may be one of a partitioned table (column=name)."""
    part = path.rlike(r"/part-[^/]*$")
    folder = F.regexp_extract(path, r"([^/=]+)/part-[^/]*$", 1)
    name = F.when(part, folder).otherwise(F.regexp_extract(path, r"([^/]+)$", 1))
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def outputs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(output, step, stem, files, length, modified, complete) of the outputs below ``path``.

    Empty files are no outputs. A file is complete if it ends with a line end; JSON must parse as well. An output in parts is complete if each part with bytes is. The step
    is that whose suffix the name ends in; other outputs have none, and all but their last extension as stem.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    rows = rows.where(~F.col("path").rlike(r"\.crc$"))
    text = F.col("content").cast("string")
    json = F.col("path").rlike(r"\.json$|^\s*$") | text.rlike(r"^\s*[\[{]")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    parses = F.try_parse_json(text).isNotNull() | F.forall(lines, lambda x: F.try_parse_json(x).isNotNull())
    whole = F.endswith(text, F.lit("\n")) & (~json | parses)
    rows = rows.select(_output(F.col("path")).alias("output"), "length", F.col("modificationTime").alias("modified"), whole.alias("whole"))
    found = rows.groupBy("output").agg(F.count("*").alias("files"), F.sum("length").alias("length"), F.max("modified").alias("modified"), F.coalesce(F.min("whole"), F.lit(False)).alias("complete"))
    step = F.coalesce(*[F.when(F.endswith("output", F.lit(s)), F.lit(k)) for k, s in sorted(SUFFIX.items(), key=lambda x: -len(x[1]))])
    ends = F.create_map(*[F.lit(x) for k, s in sorted(SUFFIX.items()) for x in (k, len(s))])
    cut = F.coalesce(F.try_element_at(ends, F.col("step")), F.length(F.regexp_extract("output", r"(?<=.)(\.[^.]*)$", 1)))
    stem = F.substring(F.col("output"), F.lit(1), F.length("output") - cut)
    return found.withColumn("step", step).withColumn("stem", stem).select("output", "step", "stem", "files", "length", "modified", "complete")


def pending(work: DataFrame, done: DataFrame, step: str, stem: str = "filestem") -> DataFrame:
    """Rows of ``work`` for whose ``stem`` no complete output of ``step`` is among ``done`` (see ``outputs``). An unknown step raises."""
    if step not in SUFFIX:
        raise ValueError(f"unknown step {step}")
    names = done.where((F.col("step") == step) & F.col("complete")).select(F.col("stem").alias(stem)).distinct()
    return work.join(names, stem, "left_anti")
