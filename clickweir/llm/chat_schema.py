r"""Chat formatting: fingerprints of record layouts select declarative mappings to turns.

A layout is the set of nested field paths of a record, such as ``messages[].role``; its
fingerprint is the SHA-256 of the sorted paths. ``MAPPINGS`` says for each known fingerprint
where role and text of each turn stand, so a new layout is a new entry and no new code. Three
sources are read: tables with one row per turn, tables with nested columns (the schema is
fingerprinted once) and a column of JSON records of mixed layouts (each record is).

Template. A turn is written as

    user       [INST] text [/INST]
    assistant  [OUT] text</s>
    other      [ROLE]role[/ROLE] text</s>

Control strings inside a text or role, and the backslash, get a backslash before them, and
lose it when the output is read back; the text after the opening mark and its blank, without
the mark that closes it, is what was said, character by character. The loss mask covers the
texts of assistant turns.

Every turn is formatted on its own, so a conversation of any length is a run of fragments in
order and never one value. Reading back streams over fragments sorted by conversation; only
the running hashes of one conversation are held.

Defined results: null role and text are empty; a null conversation id is a conversation of
its own; repeated rows are repeated turns; equal turn numbers are ordered by role, then text;
null turn numbers come first; records of unknown layout have ``layout`` null and no turns;
an empty table gives no rows; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

ASSISTANT = "assistant"
# Names that nested layouts give the three roles; turn rows keep theirs.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout stand.

    ``rows``: one row per turn, with the fields of (conversation, order, role, text).
    ``items``: a list field, with the fields of (role, text) in each item.
    ``fields``: (role, field or fields) in order; several fields are joined by a blank line,
    and a turn without any text is left out unless it is the assistant's.
    """

    name: str
    rows: tuple[str, str, str, str] | None = None
    items: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = field(default=())


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


# The layouts that are read.
LAYOUTS: list[tuple[tuple[str, ...], Mapping]] = [
    (("conv_id", "turn", "role", "text"), Mapping("turn rows", rows=("conv_id", "turn", "role", "text"))),
    (("messages[].role", "messages[].content"), Mapping("messages", items=("messages", "role", "content"))),
    (("conversations[].from", "conversations[].value"), Mapping("from/value", items=("conversations", "from", "value"))),
    (("conversation[].role", "conversation[].text"), Mapping("role/text", items=("conversation", "role", "text"))),
    (("prompt", "completion"), Mapping("completion", fields=(("user", ("prompt",)), ("assistant", ("completion",))))),
    (("prompt", "response"), Mapping("response", fields=(("user", ("prompt",)), ("assistant", ("response",))))),
    (("system", "prompt", "response"), Mapping("system prompt", fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))))),
    (("question", "answer"), Mapping("question", fields=(("user", ("question",)), ("assistant", ("answer",))))),
    (("instruction", "output"), Mapping("instruction", fields=(("user", ("instruction",)), ("assistant", ("output",))))),
    (("instruction", "input", "output"), Mapping("instruction input", fields=(("user", ("instruction", "input")), ("assistant", ("output",))))),
]
MAPPINGS = {fingerprint(paths): mapping for paths, mapping in LAYOUTS}


def schema_paths(kind: T.DataType, prefix: str = "") -> Iterator[str]:
    """Nested field paths of a Spark type."""
    if isinstance(kind, T.StructType):
        for part in kind.fields:
            yield from schema_paths(part.dataType, f"{prefix}.{part.name}" if prefix else part.name)
    elif isinstance(kind, T.ArrayType):
        yield from schema_paths(kind.elementType, f"{prefix}[]")
    else:
        yield prefix


def value_paths(value, prefix: str = "") -> Iterator[str]:
    """Nested field paths of a JSON value."""
    if isinstance(value, dict):
        for name, part in value.items():
            yield from value_paths(part, f"{prefix}.{name}" if prefix else name)
    elif isinstance(value, list):
        for part in value or [None]:
            yield from value_paths(part, f"{prefix}[]")
    else:
        yield prefix


def mapping_of(paths) -> Mapping | None:
    """The mapping of exactly these paths, or else of the most paths that are all among them."""
    paths = set(paths)
    if found := MAPPINGS.get(fingerprint(paths)):
        return found
    inside = [(len(known), mapping) for known, mapping in LAYOUTS if set(known) <= paths]
    return max(inside, key=lambda x: x[0])[1] if inside else None


def _role(role: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    plain = F.coalesce(role, F.lit(""))
    return F.coalesce(F.try_element_at(known, plain), plain)


def turns_of_table(records: DataFrame, key: str | None = None) -> DataFrame:
    """Canonical turns (conv_id, turn, role, text) of a table of one layout.

    ``key`` names the conversation of a nested layout; without it, its rows have to be
    numbered by the caller. Turn rows bring their own.
    """
    mapping = mapping_of(schema_paths(records.schema))
    if mapping is None:
        raise ValueError(f"no mapping for the layout {sorted(set(schema_paths(records.schema)))}")
    if mapping.rows:
        who, order, role, text = mapping.rows
        return records.select(
            F.col(who).alias("conv_id"), F.col(order).alias("turn"),
            F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
        )
    if key is None:
        raise ValueError("a nested layout needs a key")
    if mapping.items:
        items, role, text = mapping.items
        turn = F.posexplode(items).alias("turn", "item")
        return records.select(F.col(key).alias("conv_id"), turn).select(
            "conv_id", F.col("turn").cast("long"), _role(F.col("item")[role]).alias("role"),
            F.coalesce(F.col("item")[text], F.lit("")).alias("text"),
        )
    said = F.array(*(
        F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *(F.nullif(F.col(f), F.lit("")) for f in names)).alias("text"))
        for role, names in mapping.fields
    ))
    said = F.filter(said, lambda t: (t["text"] != "") | (t["role"] == ASSISTANT))
    return records.select(F.col(key).alias("conv_id"), F.posexplode(said).alias("turn", "said")).select(
        "conv_id", F.col("turn").cast("long"), "said.role", "said.text",
    )


def _json_turns(record: str | None) -> tuple[str | None, list[tuple[str, str]]]:
    try:
        value = json.loads(record or "")
    except ValueError:
        return None, []
    mapping = mapping_of(value_paths(value)) if isinstance(value, dict) else None
    if mapping is None or mapping.rows:
        return None, []

    def text(x) -> str:
        return "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)

    if mapping.items:
        items, role, said = mapping.items
        turns = [(text(t.get(role)), text(t.get(said))) for t in value[items] if isinstance(t, dict)]
        return mapping.name, [(ROLES.get(r, r), s) for r, s in turns]
    turns = [(role, "\n\n".join(x for f in names if (x := text(value.get(f))))) for role, names in mapping.fields]
    return mapping.name, [(r, s) for r, s in turns if s or r == ASSISTANT]


def turns_of_json(records: DataFrame, key: str, record: str) -> DataFrame:
    """Canonical turns (conv_id, turn, role, text, layout) of JSON records of mixed layouts.

    A record of no known layout gives one row with null turn, role, text and layout.
    """
    picked = records.select(F.col(key).alias("conv_id"), F.col(record).alias("record"))

    def parse(batches):
        for batch in batches:
            rows = []
            for who, body in zip(batch["conv_id"].to_pylist(), batch["record"].to_pylist(), strict=True):
                layout, turns = _json_turns(body)
                rows += [(who, i, role, text, layout) for i, (role, text) in enumerate(turns)] or [(who, None, None, None, layout)]
            yield _arrow(rows, schema)

    kind = picked.schema["conv_id"].dataType.simpleString()
    shape = f"conv_id {kind}, turn long, role string, text string, layout string"
    schema = to_arrow_schema(_parse_datatype_string(shape))
    return picked.mapInArrow(parse, shape)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as Arrow: ids stay integers beside null ones."""
    columns = zip(*rows, strict=True) if rows else ((),) * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(columns, schema.types, strict=True)], schema=schema)


_CONTROL = r"\[/?(?:INST|OUT|ROLE)\]|</?s>"
_ESCAPED = re.compile(rf"\\(\\|{_CONTROL})")
_TOKEN = re.compile(rf"\\(?:\\|{_CONTROL})|{_CONTROL}")


def _escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\|{_CONTROL})", r"\\$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """Canonical turns with ``formatted``, and the loss mask in it as ``loss_start``, ``loss_end``.

    The formatted conversation is the concatenation of its fragments by turn. Offsets are
    code points within the fragment and null outside the mask.
    """
    text = _escape(F.coalesce("text", F.lit("")))
    role = F.coalesce("role", F.lit(""))
    open_ = F.when(role == "user", "[INST] ").when(role == ASSISTANT, "[OUT] ").otherwise(
        F.concat(F.lit("[ROLE]"), _escape(role), F.lit("[/ROLE] ")))
    close = F.when(role == "user", " [/INST]").otherwise("</s>")
    masked = role == ASSISTANT
    return turns.select(
        "conv_id", "turn", role.alias("role"), F.concat(open_, text, close).alias("formatted"),
        F.when(masked, F.length(open_)).alias("loss_start"),
        F.when(masked, F.length(open_) + F.length(text)).alias("loss_end"),
    )


def _unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def read_fragment(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn in formatted text."""
    marks = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(formatted) if m[0][0] != "\\"]
    at = 0
    while at < len(marks):
        _, begin, mark = marks[at]
        if mark == "[ROLE]":
            role = _unescape(formatted[begin:marks[at + 1][0]])
            begin, at = marks[at + 1][1], at + 1
        else:
            role = "user" if mark == "[INST]" else ASSISTANT
        end = marks[at + 1][0]
        if role == "user" and mark == "[INST]":
            end -= 1
        yield role, _unescape(formatted[begin + 1:end])
        at += 2


def digest(fragments: DataFrame) -> DataFrame:
    """Per conversation, read back from the fragments: counts and hashes of turns and loss text."""
    kind = fragments.schema["conv_id"].dataType.simpleString()
    ordered = (
        fragments.select("conv_id", "turn", "role", "formatted", "loss_start", "loss_end")
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    )
    def run(batches):
        current, open_ = None, False
        turns = loss = None
        n = chars = size = 0
        for batch in batches:
            done = []
            columns = (batch[x].to_pylist() for x in ("conv_id", "formatted", "loss_start", "loss_end"))
            for conv, text, start, end in zip(*columns, strict=True):
                if not open_ or conv != current:
                    if open_:
                        done.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), size))
                    current, open_, n, chars, size = conv, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, said in read_fragment(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                if start is not None:
                    masked = _unescape(text[start:end])
                    loss.update(masked.encode())
                    chars += len(masked)
                size += len(text)
            yield _arrow(done, schema)
        if open_:
            yield _arrow([(current, n, turns.hexdigest(), chars, loss.hexdigest(), size)], schema)

    shape = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    schema = to_arrow_schema(_parse_datatype_string(shape))
    return ordered.mapInArrow(run, shape)
