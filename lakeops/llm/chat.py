"""Chat records of any known layout to one template, and back.

The nested field paths of a record are hashed; the fingerprint selects a declarative mapping to
canonical turns. Fields no mapping uses don't take part. The template marks every turn and escapes
its control strings inside texts, so a formatted conversation can be read back exactly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, combinations
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.llm.common import query, table
from lakeops.session import local_table

RENAMED = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: Layouts. ``turns``: a list and the fields of role and text in its elements; ``fields``: single
#: fields and the role each one has, in order. Optional paths may be absent.
LAYOUTS: list[dict[str, Any]] = [
    {"name": "messages", "turns": ("messages", "role", "content"), "optional": []},
    {"name": "speakers", "turns": ("conversations", "from", "value"), "rename": RENAMED, "before": [("system", "system")], "optional": ["system"]},
    {"name": "instruction", "fields": [("system", "system"), (("instruction", "input"), "user"), ("output", "assistant")], "optional": ["system", "input"]},
    {"name": "prompt-response", "fields": [("system", "system"), ("prompt", "user"), ("response", "assistant")], "optional": ["system"]},
    {"name": "prompt-completion", "fields": [("prompt", "user"), ("completion", "assistant")], "optional": []},
    {"name": "question-answer", "fields": [("question", "user"), ("answer", "assistant")], "optional": []},
    {"name": "nested", "fields": [("data.prompt.text", "user"), ("data.response.text", "assistant")], "optional": []},
]


def paths(value: Any, at: str = "") -> set[str]:
    """Paths of all leaves: a.b for members, a[] for elements; an empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{at}[]"}, *(paths(v, f"{at}[]") for v in value)) - ({f"{at}[]"} if value else set())
    return {at}


def _needed(layout: dict) -> set[str]:
    found = set()
    if "turns" in layout:
        where, role, text = layout["turns"]
        found |= {f"{where}[].{role}", f"{where}[].{text}"}
    for source, _ in [*layout.get("before", []), *layout.get("fields", [])]:
        found |= {source} if isinstance(source, str) else {*source}
    return found


KNOWN = set().union(*map(_needed, LAYOUTS)) | {f"{layout['turns'][0]}[]" for layout in LAYOUTS if "turns" in layout}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha1("\n".join(sorted(found & KNOWN)).encode()).hexdigest()[:16]


def _mappings() -> dict[str, dict]:
    out = {}
    for layout in LAYOUTS:
        every, optional = _needed(layout), layout["optional"]
        for absent in chain.from_iterable(combinations(optional, n) for n in range(len(optional) + 1)):
            shapes = [every - {*absent}]
            if "turns" in layout:  # a conversation without turns
                where = layout["turns"][0]
                shapes.append({p for p in shapes[0] if not p.startswith(f"{where}[]")} | {f"{where}[]"})
            for shape in shapes:
                out.setdefault(fingerprint(shape), layout)
    return out


MAPPINGS = _mappings()


def _get(record: Any, path: str) -> Any:
    for step in path.split("."):
        record = record.get(step) if isinstance(record, dict) else None
    return record


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical(record: Any) -> tuple[str, list[tuple[str, str]] | None]:
    """Fingerprint of a record and its (role, text) turns; no turns (None) for an unknown layout."""
    mark = fingerprint(paths(record)) if isinstance(record, dict) else fingerprint(set())
    layout = MAPPINGS.get(mark)
    if layout is None:
        return mark, None
    turns = []
    for source, role in [*layout.get("before", []), *layout.get("fields", [])]:
        several = [source] if isinstance(source, str) else source
        values = [_get(record, path) for path in several]
        if role == "system" and values[0] is None:
            continue
        turns.append((role, "\n".join(_text(v) for i, v in enumerate(values) if i == 0 or v not in (None, ""))))
    if "turns" in layout:
        where, role, text = layout["turns"]
        rename = layout.get("rename", {})
        turns += [(rename.get(r := _text(turn.get(role)), r), _text(turn.get(text))) for turn in record[where]]
    return mark, turns


# The template: begin, and what stands before and after the text of each role.
BEGIN = "<s>"
AROUND = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", "</s>")}
OTHER = ("[ROLE] ", "[/ROLE] ", " [/TURN]")
CONTROL = [BEGIN, "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[OUT]", "[ROLE]", "[/ROLE]", "[/TURN]"]
_MARKED = re.compile("|".join([r"\\", *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)]))


def escape(text: str) -> str:
    """A backslash after the first character of every control string, and every backslash doubled."""
    return _MARKED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0]}\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans the loss is taken on: texts of the assistant, escaped."""
    parts, spans, at = [BEGIN], [], len(BEGIN)
    for role, text in turns:
        before, after = AROUND.get(role) or (f"{OTHER[0]}{escape(role)}{OTHER[1]}", OTHER[2])
        body = escape(text)
        if role == "assistant":
            spans.append((at + len(before), at + len(before) + len(body)))
        parts += [before, body, after]
        at += len(before) + len(body) + len(after)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], len(BEGIN)
    while at < len(formatted):
        for role, (before, after) in AROUND.items():
            if formatted.startswith(before, at):
                at += len(before)
                break
        else:
            at += len(OTHER[0])
            end = formatted.index(OTHER[1], at)
            role, after, at = unescape(formatted[at:end]), OTHER[2], end + len(OTHER[1])
        end = formatted.index(after, at)
        turns.append((role, unescape(formatted[at:end])))
        at = end + len(after)
    return turns


def conversations_as_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): one JSON record in the messages layout for each conv_id, turns in order.

    Turns are gathered in two steps, 256 turn numbers at a time. Null turns come first, equal ones
    go by role and text; repeated rows are turns of their own; a null role or text is empty. A null
    conv_id is a conversation of its own.
    """
    turn = F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content")
    )
    parts = rows.groupBy("conv_id", F.floor(F.col("turn") / 256).alias("part")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # Each part becomes text by itself, so a long conversation is never an array of all its turns.
    message = lambda t: F.to_json(F.struct(t["role"].alias("role"), t["content"].alias("content")), {"ignoreNullFields": "false"})
    written = parts.select("conv_id", F.struct("part", F.array_join(F.transform("turns", message), ",").alias("text")).alias("written"))
    whole = written.groupBy("conv_id").agg(F.array_sort(F.collect_list("written"))["text"].alias("texts"))
    return whole.select("conv_id", F.concat(F.lit('{"messages":['), F.array_join("texts", ","), F.lit("]}")).alias("record"))


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


def format_records(records: DataFrame, record: str = "record") -> DataFrame:
    """All rows and columns as a struct ``row``, with fingerprint, formatted and loss (spans).

    Formatted is null for text that is no JSON object or has no known layout.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, texts, losses = [], [], []
            for value in batch.column("row").field(at):
                try:
                    parsed = json.loads(value.as_py() or "null")
                except ValueError:
                    parsed = None
                mark, turns = canonical(parsed)
                text, spans = (None, None) if turns is None else render(turns)
                marks.append(mark)
                texts.append(text)
                losses.append(None if spans is None else [{"start": a, "end": b} for a, b in spans])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(marks, pa.string()), pa.array(texts, pa.string()), pa.array(losses, kind)],
                names=["row", "fingerprint", "formatted", "loss"],
            )

    # The record is one of the row's columns and is sent once.
    at = records.columns.index(record)
    given = records.select(F.struct(*[records[c] for c in records.columns]).alias("row"))
    schema = T.StructType([given.schema["row"], T.StructField("fingerprint", T.StringType()), T.StructField("formatted", T.StringType()), T.StructField("loss", SPAN)])
    return given.mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds turns, parsed from the formatted text, and loss_text, what lies under the spans, unescaped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, under = [], []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                turns.append(None if text is None else [{"role": r, "text": t} for r, t in parse(text)])
                under.append(None if text is None else "".join(unescape(text[s["start"] : s["end"]]) for s in spans))
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(turns, kind), pa.array(under, pa.string())], names=[*batch.schema.names, "turns", "loss_text"]
            )

    schema = T.StructType([*formatted.schema.fields, T.StructField("turns", TURNS), T.StructField("loss_text", T.StringType())])
    return formatted.mapInArrow(run, schema)


PROBE = "</s>[INST] ok [/INST]"


@query("op8_chat_format", sql=f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
e AS (
  SELECT *, regexp_replace(replace(text, chr(92), chr(92) || chr(92)),
                           '([<\\[])(s>|/s>|SYS\\]|/SYS\\]|INST\\]|/INST\\]|OUT\\]|ROLE\\]|/ROLE\\]|/TURN\\])', '\\1' || chr(92) || chr(92) || '\\2', 'g') AS escaped FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(length(escaped) + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 ELSE 10 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = local_table(spark, [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    formatted = format_records(conversations_as_records(given.unionByName(probe)))
    # The records aren't needed any more; a long one would be carried along.
    read = read_back(formatted.withColumn("row", F.struct("row.conv_id")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("row.conv_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
