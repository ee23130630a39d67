"""Chat formatting: schema fingerprints choose a declarative mapping to canonical turns.

A record is a JSON object in any known layout. The fingerprint is a hash of its sorted nested field paths, each with the type of
its values (arrays of any length give one path, null counts as a text), so records of one layout share it however they order
their fields. Each known layout is a mapping, itself only data: where the turns are, which field holds role and text, and what
roles mean. Unknown fingerprints get no turns and ``layout`` null: they are reported, never dropped. What is no JSON, or is nested too deeply to
be read, has the fingerprint of a null.

The template writes each turn as ``### role: text</turn>`` and a line end. Inside texts and roles a backslash, ``###`` and ``</turn>`` are
escaped with backslashes, so that reading back gives exactly the texts that went in. Loss covers the text of each assistant turn.

Null texts are empty, null roles are empty roles. Turns with equal numbers come in the order of role, then text. Conversations without rows do not
exist; a record with an empty list has no turns and an empty format. Texts may be of any length. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import per_batch

TURN_END = "</turn>"
MARK = re.compile(r"\\|###|</turn>")
UNESCAPE = re.compile(r"\\(.)", re.S)
#: One marked turn; a backslash always takes the character after it along.
TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)

#: Declarative mappings. list: path of the turns; role, text: fields in a turn; roles: renamed roles. pairs: (role, path) in order.
LAYOUTS = {
    "messages": {"list": "messages", "role": "role", "text": "content", "roles": {}},
    "sharegpt": {"list": "conversations", "role": "from", "text": "value", "roles": {"human": "user", "gpt": "assistant"}},
    "chat_nested": {"list": "data.turns", "role": "speaker.name", "text": "utterance", "roles": {"User": "user", "Assistant": "assistant", "System": "system"}},
    "prompt": {"pairs": [("user", "prompt"), ("assistant", "response")]},
    "completion": {"pairs": [("user", "prompt"), ("assistant", "completion")]},
    "instruction": {"pairs": [("user", "instruction"), ("assistant", "output")]},
    "instruction_input": {"pairs": [("user", ("instruction", "input")), ("assistant", "output")]},
    "question": {"pairs": [("system", "system_prompt"), ("user", "question"), ("assistant", "response")]},
}


def paths(value) -> set[str]:
    """Every path of a value and the type at its end."""
    out, todo = set(), [("", value)]
    while todo:
        at, v = todo.pop()
        if isinstance(v, dict) and v:
            todo += [(f"{at}.{k}" if at else k, x) for k, x in v.items()]
        elif isinstance(v, list) and v:
            todo += [(at + "[]", x) for x in v]
        else:
            out.add(f"{at}:{'text' if v is None or isinstance(v, str) else type(v).__name__}")
    return out


def fingerprint(value) -> str:
    return hashlib.sha256("\n".join(sorted(paths(value))).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def known(layouts: dict = LAYOUTS) -> dict[str, str]:
    """Fingerprint -> layout name, for the full layout and for one whose list is empty."""
    out = {}
    for name, m in layouts.items():
        made: dict = {}
        if "list" in m:
            for turns in ([put(put({}, m["role"], "x"), m["text"], "x")], []):
                out[fingerprint(put({}, m["list"], turns))] = name
        else:
            for _, at in m["pairs"]:
                for path in at if isinstance(at, tuple) else (at,):
                    put(made, path, "x")
            out[fingerprint(made)] = name
    return out


def put(into: dict, path: str, value) -> dict:
    *above, last = path.split(".")
    at = into
    for k in above:
        at = at.setdefault(k, {})
    at[last] = value
    return into


def pick(value, path: str):
    for k in path.split("."):
        value = value.get(k) if isinstance(value, dict) else None
    return value


def text_at(value, path: str) -> str:
    """The text there; halves of surrogate pairs that stand alone become U+FFFD."""
    text = pick(value, path) or ""
    return text if text.isascii() else text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def turns(record: dict, mapping: dict) -> list[tuple[str, str]]:
    if "list" in mapping:
        roles = mapping["roles"]
        got = [(text_at(t, mapping["role"]), text_at(t, mapping["text"])) for t in pick(record, mapping["list"])]
        return [(roles.get(r, r), t) for r, t in got]
    out = []
    for role, at in mapping["pairs"]:
        parts = [text_at(record, p) for p in (at if isinstance(at, tuple) else (at,))]
        out.append((role, "\n\n".join(x for x in parts if x)))
    return out


def escaped(text: str, role: bool = False) -> str:
    text = MARK.sub(lambda m: {"\\": "\\\\", "###": "\\#\\#\\#", TURN_END: "\\</turn>"}[m[0]], text)
    return text.replace(":", "\\:") if role else text


def unescaped(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


def formatted(got: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of all turns, and the spans under the loss."""
    out, spans, at = [], [], 0
    for role, text in got:
        head, body = f"### {escaped(role, True)}: ", escaped(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, TURN_END, "\n"]
        at += len(head) + len(body) + len(TURN_END) + 1
    return "".join(out), spans


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out, at = [], 0
    while at < len(text):
        m = TURN.match(text, at)
        if not m:
            raise ValueError(f"not a turn at {at}")
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    return out


def chat(records: DataFrame, layouts: dict = LAYOUTS) -> DataFrame:
    """conv_id, layout, fingerprint, formatted, loss (list of spans) of each row of ``records`` (conv_id, record)."""

    def step(batches):
        by_print = known(layouts)
        for batch in batches:
            out = []
            for text in batch.column("record").to_pylist():
                try:
                    record = json.loads(text or "null")
                except (ValueError, RecursionError):
                    record = None
                mark = fingerprint(record)
                name = by_print.get(mark) if isinstance(record, dict) else None
                body, spans = formatted(turns(record, layouts[name])) if name else ("", [])
                out.append((name, mark, body, [{"start": a, "end": b} for a, b in spans]))
            kinds = (pa.string(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array([x[i] for x in out], k) for i, k in enumerate(kinds))], names=["conv_id", "layout", "fingerprint", "formatted", "loss"])

    return per_batch(records.select("conv_id", F.col("record").cast("string").alias("record")), step, "conv_id long, layout string, fingerprint string, formatted string, loss array<struct<start:long,end:long>>")


def read_back(rows: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss, from the formatted text alone."""

    def step(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                got = parsed(text or "")
                loss = "".join(unescaped(text[s["start"] : s["end"]]) for s in spans or [])
                out.append((len(got), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in got).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text or "")))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("layout"), *(pa.array([x[i] for x in out], k) for i, k in enumerate(kinds))], names=["conv_id", "layout", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return per_batch(rows.select("conv_id", "layout", "formatted", "loss"), step, "conv_id long, layout string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def as_records(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): the rows of each conversation as JSON in one of several layouts, as sources deliver them.

    Two turns, user then assistant, come as prompt and response or as instruction and output; others as lists of
    messages, in one of three layouts, by conv_id. No text changes.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    t, kind = F.col("turns"), F.pmod("conv_id", F.lit(3))
    pair = F.coalesce((F.size(t) == 2) & (F.get(t, F.lit(0))["role"] == "user") & (F.get(t, F.lit(1))["role"] == "assistant"), F.lit(False))
    user, answer = F.get(t, F.lit(0))["text"], F.get(t, F.lit(1))["text"]
    renamed = lambda x: F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"])
    # A role that is already called "human" or "gpt" would not come back: such conversations stay in the plain layout.
    plain = F.exists(t, lambda x: x["role"].isin("human", "gpt", "User", "Assistant", "System"))
    named = F.transform(t, lambda x: F.struct(F.struct(x["role"].alias("name")).alias("speaker"), x["text"].alias("utterance")))
    messages = F.to_json(F.struct(F.transform(t, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))
    record = (
        F.when(plain, messages)
        .when(pair & (kind == 0), F.to_json(F.struct(user.alias("prompt"), answer.alias("response"))))
        .when(pair & (kind == 1), F.to_json(F.struct(user.alias("instruction"), answer.alias("output"))))
        .when(kind == 0, F.to_json(F.struct(F.transform(t, lambda x: F.struct(renamed(x).alias("from"), x["text"].alias("value"))).alias("conversations"))))
        .when(kind == 1, F.to_json(F.struct(F.struct(named.alias("turns")).alias("data"))))
        .otherwise(messages)
    )
    return rows.select("conv_id", record.alias("record"))


#: A conversation whose texts hold the template's own control strings.
ESCAPED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def digests(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    more = spark.createDataFrame(ESCAPED, "conv_id long, turn long, role string, text string")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).union(more)
    return read_back(chat(as_records(rows))).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "layout")


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (
  SELECT *, length(replace(replace(replace(text, '\', '\\'), '###', '\#\#\#'), '</turn>', '\</turn>')) + length(role) + 14 AS n FROM c
), g AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, sum(n) AS formatted_chars,
         count(*) = 2 AND min(role) = 'assistant' AND max(role) = 'user' AND first(role ORDER BY turn, role, text) = 'user' AS pair
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars,
       CASE ((conv_id % 3) + 3) % 3 WHEN 0 THEN CASE WHEN pair THEN 'prompt' ELSE 'sharegpt' END
            WHEN 1 THEN CASE WHEN pair THEN 'instruction' ELSE 'chat_nested' END ELSE 'messages' END AS layout
FROM g
"""
