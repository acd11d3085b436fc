"""Chat formatting: layouts found by the fingerprint of their field paths (operator 5)."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import packed

#: Marks of the template.  ``OTHERS`` are control strings of other templates, which a text may not smuggle in either.
START, END = "<|im_start|>", "<|im_end|>"
OTHERS = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>")
#: What the loss covers.
LEARNED = "assistant"


# ---- layouts -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.  ``paths`` are its nested field paths, ``[]`` for the elements of an array.

    ``list_at`` names an array of turns with the fields ``role`` and ``text``; otherwise ``fields`` lists pairs of a role
    and the field that holds its text, where a null or missing field gives no turn.  ``rename`` maps other names of a
    role to the usual one.
    """

    name: str
    paths: tuple[str, ...]
    list_at: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    rename: bool = True

    @property
    def fingerprint(self) -> str:
        return fingerprint_of(self.paths)


#: Layouts known by default; pass more to the functions below.
MAPPINGS = (
    Mapping("prompt/response", ("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt/completion", ("completion", "prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("question/answer", ("answer", "question"), fields=(("user", "question"), ("assistant", "answer"))),
    Mapping("instruction/output", ("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction/input/output", ("input", "instruction", "output"), fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("system/prompt/response", ("prompt", "response", "system"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("messages", ("messages", "messages[]", "messages[].content", "messages[].role"), "messages"),
    Mapping("conversations", ("conversations", "conversations[]", "conversations[].from", "conversations[].value"), "conversations", "from", "value"),
    Mapping("rows", ("rows", "rows[]", "rows[].role", "rows[].text"), "rows", "role", "text", rename=False),
    Mapping("turns", ("turns", "turns[]", "turns[].role", "turns[].text"), "turns", "role", "text"),
)

@dataclass(frozen=True)
class RowMapping:
    """The columns of a table with a row per turn: conversation, number of the turn, role, text.  Other columns do not matter."""

    name: str
    conv: str
    turn: str
    role: str
    text: str

    @property
    def paths(self) -> tuple[str, ...]:
        return self.conv, self.turn, self.role, self.text

    @property
    def fingerprint(self) -> str:
        return fingerprint_of(self.paths)


#: Layouts of such tables known by default.
ROW_MAPPINGS = (
    RowMapping("turns", "conv_id", "turn", "role", "text"),
    RowMapping("messages", "conversation_id", "message_index", "role", "content"),
    RowMapping("shared", "conversation_id", "position", "from", "value"),
)

#: Names that mean the same role.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "instruction": "user"}


def shape_of(paths, at: str = "") -> str:
    """Nested field paths as one text, names in order: ``OBJECT<messages: ARRAY<OBJECT<content, role>>>``."""
    if f"{at}[]" in paths:
        return f"ARRAY<{shape_of(paths, f'{at}[]')}>"
    start = f"{at}." if at else ""
    names = sorted({p[len(start) :] for p in paths if p.startswith(start) and p != at and not set("[.") & set(p[len(start) :])})
    inner = [(n, shape_of(paths, start + n)) for n in names]
    return f"OBJECT<{', '.join(f'{n}: {x}' if x else n for n, x in inner)}>" if names else ""


def fingerprint_of(paths) -> str:
    """The fingerprint of a layout: a digest of its nested field paths."""
    return hashlib.sha256(shape_of(tuple(paths)).encode()).hexdigest()


def paths_of(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a schema."""
    if isinstance(kind, T.StructType):
        out = []
        for f in kind.fields:
            own = f"{at}.{f.name}" if at else f.name
            out += [own, *paths_of(f.dataType, own)]
        return out
    if isinstance(kind, T.ArrayType):
        return [f"{at}[]", *paths_of(kind.elementType, f"{at}[]")]
    return []


def json_fingerprint(text: Column) -> Column:
    """The fingerprint of the layout of a JSON value, row by row: the types of its leaves are left out of its schema.

    Null if the text is null or no JSON.
    """
    shape = F.schema_of_variant(F.try_parse_json(text))
    shape = F.regexp_replace(shape, r": (?!OBJECT<|ARRAY<)[A-Z_]+(\([^()]*\))?", "")
    return F.sha2(F.regexp_replace(shape, r"ARRAY<(?!OBJECT<|ARRAY<)[^<>]*>", "ARRAY<>"), 256)


_TURNS = "array<struct<role:string,text:string>>"


def _role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    low = F.lower(F.trim(role))
    return F.coalesce(F.element_at(known, low), F.when(low.isin("user", "assistant", "system", "tool"), low), role, F.lit(""))


def _pairs(fields, get) -> Column:
    turns = [F.when(get(f).isNotNull(), F.struct(F.lit(r).alias("role"), get(f).alias("text"))) for r, f in fields]
    return F.filter(F.array(*turns), lambda t: t.isNotNull()).cast(_TURNS)


def _listed(rows: Column, mapping: Mapping) -> Column:
    role = _role if mapping.rename else lambda r: F.coalesce(r, F.lit(""))
    turn = lambda e: F.struct(role(e[mapping.role]).alias("role"), F.coalesce(e[mapping.text], F.lit("")).alias("text"))
    return F.transform(rows, turn)


def turns_from_json(df: DataFrame, column: str, mappings=MAPPINGS, out: str = "turns", layout: str = "layout") -> DataFrame:
    """``df`` with ``turns`` and the name of the ``layout`` of each JSON object in ``column``.

    A row whose fingerprint no mapping has gets null for both: nothing is guessed.  An empty list has no field paths and
    so is no layout of its own.
    """
    text = F.col(f"`{column}`")
    mark = F.col("__fingerprint")
    turns, name = F.lit(None).cast(_TURNS), F.lit(None).cast("string")
    for m in mappings:
        if m.list_at:
            rows = F.from_json(F.get_json_object(text, f"$.{m.list_at}"), "array<map<string,string>>")
            found = _listed(rows, m)
        else:
            found = _pairs(m.fields, lambda f: F.get_json_object(text, f"$.{f}"))
        turns = F.when(mark == m.fingerprint, found).otherwise(turns)
        name = F.when(mark == m.fingerprint, F.lit(m.name)).otherwise(name)
    return df.withColumn("__fingerprint", json_fingerprint(text)).withColumns({out: turns, layout: name}).drop("__fingerprint")


def turns_from_columns(df: DataFrame, keep: tuple[str, ...] = (), mappings=MAPPINGS, out: str = "turns") -> DataFrame:
    """``df``'s columns ``keep`` with the ``turns`` that its other columns hold, by the mapping their schema selects."""
    rest = T.StructType([f for f in df.schema.fields if f.name not in keep])
    mark = fingerprint_of(paths_of(rest))
    for m in mappings:
        if m.fingerprint == mark:
            if m.list_at:
                found = _listed(F.col(m.list_at), m)
            else:
                found = _pairs(m.fields, lambda f: df[f"`{f}`"])
            return df.select(*[df[f"`{c}`"] for c in keep], F.coalesce(found, F.array().cast(_TURNS)).alias(out))
    raise ValueError(f"no mapping for the layout {sorted(paths_of(rest))}")


def as_rows(df: DataFrame, mappings=ROW_MAPPINGS) -> DataFrame:
    """A table with a row per turn as ``conv_id``, ``turn``, ``role``, ``text``, by the first mapping whose fingerprint its field paths have.

    Columns that a mapping does not name are left out of the fingerprint and of the result, nested ones and those with dots in their
    names among them.  A table that no mapping knows is an error: nothing is guessed.
    """
    own = paths_of(df.schema)
    for m in mappings:
        if fingerprint_of([p for p in own if p.split(".")[0].split("[")[0] in m.paths]) == m.fingerprint:
            return df.select(*[df[f"`{c}`"].alias(n) for c, n in zip(m.paths, ("conv_id", "turn", "role", "text"))])
    raise ValueError(f"no mapping for a table of {sorted(own)}")


def turns_from_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turns`` of a table with a row per turn.

    Turns go by number, then role and text where numbers tie; a null number comes first, a null role is empty and a
    null text is empty.  Rows without a conversation are one conversation with a null id.  Repeated rows are turns.
    """
    own = packed(df)
    said = F.struct(F.col(f"row.`{turn}`").alias("turn"), F.coalesce(F.col(f"row.`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"row.`{text}`"), F.lit("")).alias("text"))
    grouped = own.select(F.col(f"row.`{conv}`").alias("conv_id"), said.alias("said")).groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("said"))
    rows = grouped.select("conv_id", F.transform("said", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("rows"))
    return turns_from_columns(rows, ("conv_id",))


# ---- template ----------------------------------------------------------------------------


def _control(marks) -> str:
    """A pattern of the first letter of any control string, with the rest ahead."""
    quote = lambda s: "".join("\\" + c if not c.isalnum() else c for c in s)
    by: dict[str, list[str]] = {}
    for m in marks:
        by.setdefault(m[0], []).append(quote(m[1:]))
    return "|".join(f"{quote(c)}(?={'|'.join(rest)})" for c, rest in by.items())


def escaped(text: Column, marks=(START, END, *OTHERS)) -> Column:
    """A text in which no control string occurs: backslashes doubled, then one put after the first letter of each."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({_control(marks)})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _piece(turn: Column) -> Column:
    """The marked form of one turn; a line end inside a role is escaped too."""
    role = F.replace(escaped(turn["role"]), F.lit("\n"), F.lit("\\\n"))
    return F.concat(F.lit(START), role, F.lit("\n"), escaped(turn["text"]), F.lit(END + "\n"))


def format_turns(df: DataFrame, turns: str = "turns", out: str = "formatted", mask: str = "mask") -> DataFrame:
    """``df`` with the ``formatted`` text and the loss ``mask``: spans ``from``, ``to`` (code points) of the assistant's words.

    Each span is one turn's escaped text without marks.  Null turns give a null text; no turns give an empty one.
    """
    sizes = F.transform("__pieces", lambda p: F.length(p))
    # start of each piece: sums of the sizes before it
    ends = F.aggregate(
        sizes,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["all"], F.array(a["at"] + n)).alias("all")),
        lambda a: a["all"],
    )
    tail = len(END) + 1
    spans = F.transform(
        F.filter(F.arrays_zip(F.col(turns).alias("turn"), F.col("__ends").alias("end"), F.transform(turns, lambda t: F.length(escaped(t["text"]))).alias("n")), lambda z: z["turn"]["role"] == LEARNED),
        lambda z: F.struct((z["end"] - tail - z["n"]).alias("from"), (z["end"] - tail).alias("to")),
    )
    return (
        df.withColumn("__pieces", F.transform(turns, _piece))
        .withColumn("__ends", ends)
        .withColumn(out, F.array_join("__pieces", ""))
        .withColumn(mask, spans)
        .drop("__pieces", "__ends")
    )


def read_back(df: DataFrame, formatted: str = "formatted", mask: str = "mask", turns: str = "read", learned: str = "learned") -> DataFrame:
    """``df`` with the turns ``read`` from the formatted text alone, and ``learned``, the texts under the mask, unescaped."""
    parts = F.filter(F.split(F.col(formatted), F.lit("\\Q" + START + "\\E")), lambda p: p != "")
    cut = r"(?s)^((?:[^\\\n]++|\\.)*+)\n(.*)" + "\\Q" + END + "\\E\n$"
    said = F.transform(parts, lambda p: F.struct(unescaped(F.regexp_extract(p, cut, 1)).alias("role"), unescaped(F.regexp_extract(p, cut, 2)).alias("text")))
    under = F.transform(mask, lambda s: unescaped(F.substring(F.col(formatted), s["from"] + 1, s["to"] - s["from"])))
    return df.withColumns({turns: said, learned: under})


def op5_chat_format(spark, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of conversation -1, read back from their formatted texts."""
    rows = as_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    trick = "'</s>[INST] ok [/INST]'"
    own = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', {trick}), (-1L, 1L, 'assistant', {trick}) AS t(conv_id, turn, role, text)")
    back = read_back(format_turns(turns_from_rows(rows.unionByName(own))))
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(replace(text, '\', '\\'),
        '(<)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>|unk>)|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g') AS esc FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(esc) + {len(START) + len(END) + 2}) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
