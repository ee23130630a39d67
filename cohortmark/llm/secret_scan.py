"""Secret scans with multipart credential linking.

Base spans (assign, access, hex) come from fixed patterns over the whole text. The method adds weak candidates, which mean
nothing alone: identifier fields (``client_id = ...``), mixed-case random-looking tokens and endpoints. All parts of a
document, base ones included, go to an interval join by document, scope (a block between empty lines) and distance: a weak secret is
reported if an access identifier is near, a weak identifier if a secret is near, an endpoint if both are.
The join is a semi-join on bins of the distance, so a place with many parts costs no pairs.

Offsets are code points, ends exclusive. Spans with one start stand in the order of kinds. Null and empty texts have no spans. Texts of any length are scanned whole. Repeated rows
give repeated results: rows are told apart by an id of their own. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .runtime import cut, per_batch, text_steps

KINDS = ("assign", "access", "hex", "linked_id", "linked_secret", "linked_endpoint")
RANK = {k: i for i, k in enumerate(KINDS)}
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("passw", "secret", "token", "api")
WEAK_ID = re.compile(r"""(?<![A-Za-z0-9])(?:client|access[_-]?key|account|tenant|app|user)[_-]?(?:id|name)["']?[\x20\t]*[:=][\x20\t]*["']?([A-Za-z0-9._@-]{4,})""", re.I | re.A)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"https?://[^\s\"'<>]{4,}|(?<![A-Za-z0-9.-])[a-z0-9-]+(?:\.[a-z0-9-]+)+:[0-9]{2,5}(?![0-9])")
BITS = 3.5
#: Code points between parts of one credential.
NEAR = 400
IS_HEX = np.zeros(256, bool)
IS_HEX[[ord(c) for c in "0123456789abcdef"]] = True

PARTS = "array<struct<role:string,start:long,end:long,strong:boolean,scope:long>>"
SCHEMA = f"uid long, doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base array<{S.SPAN}>, parts {PARTS}"


def entropy(text: str) -> float:
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values())


def random_looking(text: str) -> bool:
    return any(c.isdigit() for c in text) and any(c.isupper() for c in text) and any(c.islower() for c in text) and entropy(text) >= BITS


def base_spans(text: str, long_hex: bool) -> list[tuple[int, int, int, str]]:
    out, low = [], text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), RANK["assign"], m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), RANK["access"], m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if long_hex:
        out += [(m.start(), RANK["hex"], m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out)


def parts(text: str, base: list[tuple[int, int, int, str]]) -> list[dict]:
    """Strong parts from the base spans, weak ones outside of them, each with its scope; none if no identifier is there."""
    ids = [(m.start(), m.end(), False) for m in WEAK_ID.finditer(text)] if ":" in text or "=" in text else []
    ids += [(s, e, True) for s, _, e, k in base if k == "access"]
    if not ids:
        return []
    taken = S.Taken((s, e) for s, _, e, _ in base)
    found = [("id", s, e, strong) for s, e, strong in ids if strong or taken.free(s, e)]
    found += [("secret", s, e, True) for s, _, e, k in base if k != "access"]
    found += [("endpoint", *m.span(), False) for m in ENDPOINT.finditer(text) if taken.free(*m.span())]
    named = S.Taken((s, e) for r, s, e, _ in found if r != "secret")
    for m in WEAK_SECRET.finditer(text):
        s, e = m.span()
        if taken.free(s, e) and named.free(s, e) and random_looking(m[0]):
            found.append(("secret", s, e, False))
    gaps = [m.end() for m in re.finditer(r"\n[\x20\t\r]*\n", text)]
    at = np.searchsorted(gaps, [s for _, s, _, _ in found], "right") if gaps else np.zeros(len(found), int)
    return [{"role": r, "start": s, "end": e, "strong": w, "scope": int(k)} for (r, s, e, w), k in zip(found, at, strict=True)]


def scanned(batches):
    for batch in batches:
        for i, j, data, off in text_steps(batch.column("text")):
            long_hex = S.longest_runs(IS_HEX[data], off) >= 24
            rows = []
            for text, hexes in zip(batch.column("text").slice(i, j - i).to_pylist(), long_hex, strict=True):
                text = text or ""
                base = base_spans(text, bool(hexes))
                n = Counter(k for *_, k in base)
                rows.append((n["assign"], n["access"], n["hex"], S.digest(base), [S.as_struct(x) for x in base], parts(text, base)))
            cols = list(zip(*rows, strict=True))
            span = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string())]))
            part = pa.list_(pa.struct([("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("strong", pa.bool_()), ("scope", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span, part)
            yield pa.RecordBatch.from_arrays([batch.column("uid").slice(i, j - i), batch.column("doc_id").slice(i, j - i), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["uid", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "parts"])


def near(left: DataFrame, right: DataFrame, distance: int) -> DataFrame:
    """Rows of ``left`` with a row of ``right`` in the same document and scope at most ``distance`` code points away."""
    # A part covers every bin from its start to its end, the left one with ``distance`` on both sides: near parts share a bin.
    bins = lambda more: F.explode(F.sequence(F.floor((F.col("start") - more) / distance), F.floor((F.col("end") + more) / distance)))
    left = left.withColumn("bin", bins(distance))
    right = right.select(F.col("uid").alias("u"), F.col("scope").alias("c"), F.col("start").alias("s"), F.col("end").alias("e"), bins(0).alias("b"))
    gap = F.greatest(F.col("s") - F.col("end"), F.col("start") - F.col("e"))
    on = (F.col("uid") == F.col("u")) & (F.col("scope") == F.col("c")) & (F.col("bin") == F.col("b")) & (gap <= distance)
    return left.join(right, on, "left_semi").drop("bin").distinct()


def secret_scan(docs: DataFrame, distance: int = NEAR) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of each row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = cut(per_batch(docs, scanned, SCHEMA))
    part = rows.where(F.size("parts") > 1).select("uid", F.explode("parts").alias("p")).select("uid", "p.*")
    ids, secrets, ends = (part.where(F.col("role") == r) for r in ("id", "secret", "endpoint"))
    pieces = [
        near(secrets.where("not strong"), ids, distance).withColumn("kind", F.lit("linked_secret")),
        near(ids.where("not strong"), secrets, distance).withColumn("kind", F.lit("linked_id")),
        near(near(ends, ids, distance), secrets, distance).withColumn("kind", F.lit("linked_endpoint")),
    ]
    added = pieces[0].union(pieces[1]).union(pieces[2])
    rank = F.element_at(F.create_map(*[F.lit(x) for k, r in RANK.items() for x in (k, r)]), F.col("kind"))
    added = added.groupBy("uid").agg(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind")).alias("added"))
    out = rows.drop("parts").join(added, "uid", "left")
    every = F.concat("base", F.coalesce("added", F.from_json(F.lit("[]"), f"array<{S.SPAN}>")))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", S.joined(every).alias("spans"), F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_linked"))
