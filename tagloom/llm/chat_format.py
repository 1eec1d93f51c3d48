"""Chat formatting of heterogeneous layouts.

A layout is recognised by its fingerprint: a hash of its nested field paths (names only, array elements as []), of those
paths that any mapping speaks of; other fields are optional everywhere. The fingerprint selects a declarative mapping, and the
mapping says where conversations, turns, roles and texts are. A list of messages that is null or empty has a fingerprint of its own, with
the same mapping. All layouts become canonical turns, which a template marks up; control strings inside texts are escaped reversibly,
and the loss mask is the list of code point ranges of assistant texts.

    <|role|>\\n text <|end|>\\n

A text's &, < and [ become entities, a role's | and > too, so no control string of this or other templates survives
inside a text and the output can be split again.

A conversation becomes one string and so has to fit a row; its turns meet in one task for that. Null roles and texts
are empty; turns with equal numbers are ordered by role and text; a null conversation id is a conversation. A JSON row that is
no object, is not JSON at all or has no known layout gives no turns, and `layouts_of_json` lists it with a null layout; so does
a message list whose elements are no objects. A table whose schema has no known layout is an error when the plan is made.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import slices

END = "<|end|>\n"
#: Characters that texts may not show, with their entities; & first.
ENTITIES = {"&": "&amp;", "<": "&lt;", "[": "&lsqb;", "|": "&vert;", ">": "&gt;"}
TEXT_ESCAPES, ROLE_ESCAPES = "&<[", "&<[|>"
TURN = r"<\|([^|<]*)\|>\n([^<]*)<\|end\|>\n"


@dataclass(frozen=True)
class Mapping:
    """kind `rows`: a row for each turn. kind `row`: a row for each conversation; its turns are the parts
    (role, path) in this order, and a path ending in [] with role and text paths stands for a list of messages."""

    name: str
    kind: str
    conversation: str
    turn: str = ""
    role: str = ""
    text: str = ""
    parts: tuple[tuple[str, str], ...] = ()
    messages: str = ""
    rename: tuple[tuple[str, str], ...] = ()


MAPPINGS = (
    Mapping("turn_rows", "rows", "conv_id", "turn", "role", "text"),
    Mapping("prompt_response", "row", "id", parts=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", "row", "id", parts=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("system_prompt_response", "row", "id", parts=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", "row", "id", parts=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", "row", "id", parts=(("user", "instruction+input"), ("assistant", "output"))),
    Mapping("messages", "row", "id", messages="messages", role="role", text="content"),
    Mapping("conversations", "row", "id", messages="conversations", role="from", text="value", rename=(("human", "user"), ("gpt", "assistant"))),
)


def paths_of(schema: T.DataType, at: str = "") -> Iterator[str]:
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            yield from paths_of(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(schema, T.ArrayType):
        yield from paths_of(schema.elementType, f"{at}[]")
    else:
        yield at


def paths_of_value(value: object, at: str = "") -> Iterator[str]:
    """The paths of a JSON value; of a list, those of all elements. An empty list is the path of its elements."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from paths_of_value(v, f"{at}.{k}" if at else k)
    elif isinstance(value, list) and value:
        for v in value:
            yield from paths_of_value(v, f"{at}[]")
    else:
        yield f"{at}[]" if isinstance(value, list) else at


def mapping_paths(m: Mapping) -> list[str]:
    if m.kind == "rows":
        return [m.conversation, m.turn, m.role, m.text]
    if m.messages:
        return [m.conversation, f"{m.messages}[].{m.role}", f"{m.messages}[].{m.text}"]
    return [m.conversation, *(x for _, p in m.parts for x in p.split("+"))]


def layouts(m: Mapping) -> list[list[str]]:
    """The sets of paths that a mapping reads: its own, and those of a null or empty list of messages."""
    return [mapping_paths(m), *([[m.conversation, m.messages], [m.conversation, f"{m.messages}[]"]] if m.messages else [])]


def known_paths(mappings: Iterable[Mapping]) -> frozenset[str]:
    return frozenset(p for m in mappings for layout in layouts(m) for p in layout)


KNOWN = known_paths(MAPPINGS)


def fingerprint(paths: Iterable[str], known: frozenset[str] = KNOWN) -> str:
    return hashlib.sha256("\n".join(sorted(known.intersection(paths))).encode()).hexdigest()[:16]


BY_FINGERPRINT = {fingerprint(layout): m for m in MAPPINGS for layout in layouts(m)}


def mapping_for(paths: Iterable[str]) -> Mapping:
    paths = sorted(set(paths))
    try:
        return BY_FINGERPRINT[fingerprint(paths)]
    except KeyError:
        raise ValueError(f"no mapping for the layout {paths}") from None


def canonical_turns(df: DataFrame, mapping: Mapping | None = None) -> DataFrame:
    """(conv_id string or its own type, turn, role, text), a row for each turn, of a table in a known layout."""
    m = mapping or mapping_for(paths_of(df.schema))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    role = lambda c: functools.reduce(lambda out, r: F.when(c == r[0], r[1]).otherwise(out), m.rename, text(c))
    if m.kind == "rows":
        return df.select(F.col(m.conversation).alias("conv_id"), F.col(m.turn).cast("long").alias("turn"), role(F.col(m.role)).alias("role"), text(F.col(m.text)).alias("text"))
    if m.messages:
        turns = df.select(F.col(m.conversation).alias("conv_id"), F.posexplode(m.messages).alias("turn", "m"))
        return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role(F.col(f"m.{m.role}")).alias("role"), text(F.col(f"m.{m.text}")).alias("text"))
    joined = lambda p: F.concat_ws("\n", *(F.when(text(F.col(x)) != "", text(F.col(x))) for x in p.split("+")))
    parts = F.array(*(F.struct(F.lit(r).alias("role"), joined(p).alias("text")) for r, p in m.parts))
    return df.select(F.col(m.conversation).alias("conv_id"), F.posexplode(parts).alias("turn", "m")).select("conv_id", F.col("turn").cast("long").alias("turn"), "m.role", "m.text")


def json_turns(value: object) -> tuple[str | None, list[tuple[str, str]]]:
    """The mapping's name and (role, text) for each turn of one JSON conversation; no name and no turns if it has no known layout."""
    m = BY_FINGERPRINT.get(fingerprint(paths_of_value(value))) if isinstance(value, dict) else None
    if m is None or m.kind != "row":
        return None, []
    rename = dict(m.rename)
    if m.messages:
        rows = value[m.messages] or []
        if not all(isinstance(x, dict) for x in rows):
            return None, []
        return m.name, [(rename.get(role, role), text) for role, text in ((_text(x.get(m.role)), _text(x.get(m.text))) for x in rows)]
    return m.name, [(r, "\n".join(x for x in (_text(value[c]) for c in p.split("+")) if x)) for r, p in m.parts]


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _parsed(text: str | None) -> object:
    try:
        return json.loads(text) if text else None
    except (ValueError, RecursionError):
        return None


def _json_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        rows = []
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            layout, turns = json_turns(_parsed(text))
            rows += [(key, k, r, t, layout) for k, (r, t) in enumerate(turns)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))], ["conv_id", "turn", "role", "text", "layout"])


def _json_layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        found = [json_turns(_parsed(text)) for text in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([len(f[1]) for f in found], pa.int64())], ["conv_id", "layout", "n_turns"])


def _json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("conv_id"), F.col(json_col).cast("string").alias("json"))


def canonical_turns_of_json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv_id, turn, role, text, layout) of rows whose layouts differ from row to row: each row's own fingerprint selects its mapping."""
    return _json(df, id_col, json_col).mapInArrow(_json_rows, "conv_id string, turn long, role string, text string, layout string")


def layouts_of_json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv_id, layout, n_turns) of every row; layout is null where no mapping reads it."""
    return _json(df, id_col, json_col).mapInArrow(_json_layouts, "conv_id string, layout string, n_turns long")


def escape(c: Column, characters: str) -> Column:
    return functools.reduce(lambda out, x: F.replace(out, F.lit(x), F.lit(ENTITIES[x])), characters, c)


def unescape(c: Column) -> Column:
    return functools.reduce(lambda out, x: F.replace(out, F.lit(ENTITIES[x]), F.lit(x)), reversed(ROLE_ESCAPES), c)


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss): one row for each conversation; loss has the [from, to) of the loss mask in code points."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    head = F.concat(F.lit("<|"), escape(F.col("role"), ROLE_ESCAPES), F.lit("|>\n"))
    rows = turns.select("conv_id", "turn", "role", "text", head.alias("head"), escape(F.col("text"), TEXT_ESCAPES).alias("body"))
    size = F.length("head") + F.length("body") + len(END)
    rows = rows.select("*", F.row_number().over(order).alias("k"), (F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("body") - len(END)).alias("from"))
    piece = F.struct("k", F.concat("head", "body", F.lit(END)).alias("piece"), (F.col("role") == loss_role).alias("loss"), "from", (F.col("from") + F.length("body")).alias("to"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    masked = F.transform(F.filter("p", lambda x: x["loss"]), lambda x: F.struct(x["from"].alias("from"), x["to"].alias("to")))
    return chats.select("conv_id", F.array_join(F.col("p.piece"), "").alias("formatted"), masked.alias("loss"))


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars), from the formatted string and the mask alone."""
    pick = lambda g: F.regexp_extract_all("formatted", F.lit(TURN), F.lit(g))
    turns = F.zip_with(pick(1), pick(2), lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text")))
    masked = F.array_join(F.transform("loss", lambda x: unescape(F.substring(F.col("formatted"), (x["from"] + 1).cast("int"), (x["to"] - x["from"]).cast("int")))), "")
    return chats.select("conv_id", turns.alias("turns"), masked.alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))
