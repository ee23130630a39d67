"""WARC archives: written by Spark's text writer, read by a Python data source.

Writing is a DataFrame job: a record is one string whose terminator (two line ends) is the writer's line separator, so files appear
through Spark's commit protocol on any file system that it knows, and uncompressed unless asked for, so that a reader can seek. Equal payloads of at least ``REVISIT_BYTES`` bytes are
stored once: the largest page_id is the ``response``, others are ``revisit`` records that refer to it.

The source ``warc`` plans partitions from the file listing (small files together, one file never cut), takes filters on
``record_type``, ``record_id``, ``target_uri`` and ``refers_to``, reads each record's headers first and seeks over
blocks that no kept record needs. Option ``payload``: ``digest`` (default: length and SHA-1 from the payload), ``bytes`` (the payload as
well) or ``skip`` (headers only, no block is read). Files ending in .gz are read through gzip, which inflates what it skips. Files are opened by Arrow's
file systems under the names that Spark uses (``file:``, ``hdfs:``, ``viewfs:``, ``s3a:``, ``gs:``, ``abfss:``). Reading turns the session's filter pushdown
to Python sources on.

Null html counts as empty (a response of 0 bytes), null urls as empty. Of equal page_ids with equal payloads each is the response. Texts of any length make one record. Repeated rows make
repeated records. Extra columns are ignored. No rows make no records. A broken record raises ValueError with file and offset.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith

from .runtime import join_skewed, shared_path, ship, small_enough

REVISIT_BYTES = 1000
#: At most so many repeated payloads (about 60 bytes each) go out as a broadcast; beyond, the join shuffles the pages.
FEW_REPEATED = 500_000
END = "\r\n"
HTTP = "HTTP/1.1 200 OK" + END + "Content-Type: text/html; charset=utf-8" + END + END
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_bytes long, payload_digest string, headers map<string,string>, payload binary"


def records(pages: DataFrame, least: int = REVISIT_BYTES, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: the WARC record of each page, without its terminator."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]", " ").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html")).withColumn("digest", F.sha1("html"))
    first = rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    if small_enough(first, FEW_REPEATED):  # the payloads stay where they are
        rows = rows.join(F.broadcast(first), "digest", "left")
    else:
        rows = join_skewed(rows, first, "digest", "left")
    revisit = (F.col("bytes") >= least) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    name = lambda i: F.concat(F.lit("<urn:page:"), i.cast("string"), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(END))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP), F.col("html")))
    head = [
        F.lit("WARC/1.1" + END),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.coalesce(name(F.col("page_id")), F.lit("<urn:page:>"))),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("first_id"))), line("X-Payload-Length", F.col("bytes").cast("string")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
    ]
    return rows.select(F.concat(*head, block).alias("value"))


def write(pages: DataFrame, path: str, compression: str = "none", **how) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``; compression is none or gzip."""
    records(pages, **how).write.option("lineSep", END * 2).option("compression", compression).text(path)


def read(spark: SparkSession, path: str, payload: str = "digest") -> DataFrame:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("path", path).option("payload", payload).load()


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


def opened(uri: str):
    """(file system, path) of a path or URI."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if scheme == "file":
        uri = "/" + rest.lstrip("/")
    elif scheme in ("s3a", "s3n"):
        uri = "s3" + colon + rest
    return fs.FileSystem.from_uri(uri)


class WarcReader(DataSourceReader):
    FIELDS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to"}

    def __init__(self, options):
        self.path, self.payload = options["path"], options.get("payload", "digest")
        self.split = int(options.get("splitbytes", options.get("splitBytes", 64 << 20)))
        if self.payload not in ("digest", "bytes", "skip"):
            raise ValueError(f"payload: {self.payload}")
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in self.FIELDS and isinstance(f, EqualTo):
                self.tests.append((name, "in", [f.value]))
            elif name in self.FIELDS and isinstance(f, In):
                self.tests.append((name, "in", list(f.value)))
            elif name in self.FIELDS and isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", f.value))
            elif name in self.FIELDS and isinstance(f, IsNotNull):
                self.tests.append((name, "has", None))
            else:
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        system, path = opened(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        found = sorted((f for f in found if f.is_file and f.size and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
        out, size = [], self.split
        for f in found:
            if size + f.size > self.split:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(f.path)
            size += f.size
        return out or [Files([])]

    def wanted(self, values: dict) -> bool:
        for name, kind, value in self.tests:
            own = values[name]
            if own is None or kind == "in" and own not in value or kind == "starts" and not own.startswith(value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                source = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
                size_known = None if source is not raw else raw.size()
                for row in self.records(io.BufferedReader(source, 1 << 20), path, size_known):
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if len(rows) >= 2000 or size >= 16 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    def records(self, source, path: str, size_known: int | None = None):
        """Rows of a file. A seek may run past the end of a plain file without a word, so its size is asked first; in a compressed one it stops early."""
        while line := source.readline():
            if line.strip() == b"":
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record at {source.tell() - len(line)} of {path}")
            head = {}
            while (line := source.readline()) not in (b"\r\n", b"\n", b""):
                key, _, value = line.decode("utf-8", "replace").partition(":")
                head[key.strip().lower()] = value.strip()
            length = int(head.get("content-length", 0))
            values = {name: head.get(field) for name, field in self.FIELDS.items()}
            if self.payload == "skip" or not self.wanted(values):
                end = source.tell() + length
                if size_known is not None and end > size_known or source.seek(length, 1) < end:
                    raise ValueError(f"cut record at the end of {path}")
                if not self.wanted(values):
                    continue
                size, digest, payload = head.get("x-payload-length"), head.get("warc-payload-digest", "").rpartition(":")[2], None
            else:
                block = source.read(length)
                if len(block) < length:
                    raise ValueError(f"cut record at the end of {path}")
                payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
                if values["record_type"] == "revisit":
                    size, digest, payload = head.get("x-payload-length"), head.get("warc-payload-digest", "").rpartition(":")[2], None
                else:
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
            yield (values["record_id"], values["record_type"], values["target_uri"], head.get("warc-date"), values["refers_to"], None if size is None else int(size), digest, head, payload if self.payload == "bytes" else None)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
    cols = [pa.array([list(r[i].items()) for r in rows] if i == 7 else [r[i] for r in rows], k) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in SCHEMA.split(", ")])


def round_trip(pages: DataFrame) -> DataFrame:
    """Write every page to archives in the shared folder, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are read with their payloads; of revisits, which have none, only the headers.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write(pages, path)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) AS long)")
    both = read(spark, path).where("record_type = 'response'").union(read(spark, path, "skip").where("record_type = 'revisit'"))
    return both.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
     w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM w
"""
