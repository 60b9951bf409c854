"""Operator 2: chat formatting; DataFrame and SQL functions only.

Records come in several layouts. A layout is told by its fingerprint, the hash of its nested
field paths ([] marks the elements of an array). Of a record's own paths those that a layout
has are hashed; the first layout, in the order of LAYOUTS, whose fingerprint comes out selects
its declarative mapping into canonical turns, array<struct<role, text>>. So fields that a layout
doesn't name are ignored. A frame's paths are those of its schema; a JSON record's are read off
each record by itself, from all elements of its lists; a list without elements has no turns.

Formatted text: for each turn `<s>role`, a line feed, the text, `</s>`. A backslash goes before
each backslash in a role or text, before each line feed in a role, and into each control string
(`<s>` becomes `<\\s>`), so no text can hold one and all texts come back unchanged. `loss` has
the ranges of code points of `formatted` that are assistants' texts.

Turns of a conversation are ordered by turn, then role, then text (nulls first); repeated rows
stay. A null role or text is an empty string; a null conv_id is a conversation of its own. An
empty table gives an empty result. A conversation is one row, so the longest must fit a task;
its text and its number of turns are otherwise free. A JSON record of no known layout, or that
doesn't parse, has null turns; a frame of no known layout is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEGIN, END = "<s>", "</s>"
#: Control strings; they may not occur in what is escaped. The last two are those of a common template.
CONTROL = (BEGIN, END, "[INST]", "[/INST]")
TURNS = "array<struct<role:string,text:string>>"
#: Names of roles in other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


def paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; [] marks the elements of an array."""
    if isinstance(kind, T.ArrayType):
        return paths(kind.elementType, prefix + "[]")
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    return [prefix]


def fingerprint(field_paths: list[str]) -> str:
    return hashlib.md5("\n".join(sorted(field_paths)).encode()).hexdigest()


def _role(c: Column) -> Column:
    named = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.element_at(named, c), c, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _listed(field: str, role: str, text: str) -> Callable[[Column], Column]:
    return lambda r: F.transform(r[field], lambda m: _turn(_role(m[role]), m[text]))


def _pair(user: list[str], assistant: str, system: str | None = None) -> Callable[[Column], Column]:
    def made(r: Column) -> Column:
        asked = F.array_join(F.filter(F.array(*[F.coalesce(r[f], F.lit("")) for f in user]), lambda x: x != ""), "\n\n")
        turns = [_turn(F.lit("user"), asked), _turn(F.lit("assistant"), r[assistant])]
        return F.array(*([_turn(F.lit("system"), r[system])] if system else []), *turns)

    return made


#: DDL of a layout and what makes turns of a record of it (None: a row is one turn, see _grouped()). The first that fits counts, so those of more fields come first. Add a layout here and nowhere else.
LAYOUTS: list[tuple[str, Callable[[Column], Column] | None]] = [
    ("conv_id long, turn long, role string, text string", None),
    ("messages array<struct<role string, content string>>", _listed("messages", "role", "content")),
    ("conversations array<struct<from string, value string>>", _listed("conversations", "from", "value")),
    ("dialog array<struct<speaker string, text string>>", _listed("dialog", "speaker", "text")),
    ("instruction string, input string, output string", _pair(["instruction", "input"], "output")),
    ("instruction string, context string, response string", _pair(["instruction", "context"], "response")),
    ("system string, prompt string, response string", _pair(["prompt"], "response", "system")),
    ("prompt string, completion string", _pair(["prompt"], "completion")),
    ("prompt string, response string", _pair(["prompt"], "response")),
    ("question string, answer string", _pair(["question"], "answer")),
    ("instruction string, output string", _pair(["instruction"], "output")),
]
ROWS = ("conv_id", "turn", "role", "text")


def _known() -> list[tuple[str, list[str], T.StructType, Callable[[Column], Column] | None]]:
    """Fingerprint, paths, schema and mapping of each layout."""
    parsed = [(T.StructType.fromDDL(ddl), made) for ddl, made in LAYOUTS]
    return [(fingerprint(paths(schema)), paths(schema), schema, made) for schema, made in parsed]


def _under(name: str) -> Callable[[Column], Column]:
    return lambda field: F.concat(F.lit(f"{name}[]."), field)


def record_paths(record: Column) -> Column:
    """Nested field paths of each JSON record, down to the fields of the elements of its lists; of an empty list the list's own."""
    none, keys = F.array().cast("array<string>"), F.json_object_keys(record)
    out = keys
    for name in sorted({p.split("[]")[0] for _, known, *_ in _known() for p in known if "[]" in p}):
        value = F.get_json_object(record, f"$.{name}")
        elements = F.from_json(value, "array<map<string,string>>")
        fields = F.array_distinct(F.flatten(F.transform(elements, lambda x: F.coalesce(F.map_keys(x), none))))
        own = F.when(F.size(fields) > 0, F.transform(fields, _under(name))).otherwise(F.array(F.lit(f"{name}[]")))
        out = F.concat(out, F.when(F.array_contains(keys, name) & value.startswith("["), own).otherwise(none))
    return out


def _hashed(found: Column) -> Column:
    return F.md5(F.array_join(F.array_sort(F.array_distinct(found)), "\n"))


def json_turns(record: Column) -> Column:
    """Canonical turns of each JSON record, by its own fingerprint."""
    def mapped(found: Column) -> Column:
        out = F.lit(None).cast(TURNS)
        for key, known, schema, made in reversed(_known()):
            if made is None:
                continue  # rows of turns, not records
            mine = _hashed(F.array_intersect(found, F.lit(known))) == key
            out = F.when(mine, made(F.from_json(record, schema)).cast(TURNS)).otherwise(out)
            if len({p.split("[]")[0] for p in known}) == 1 and "[]" in known[0]:
                out = F.when(F.array_contains(found, known[0].split("[]")[0] + "[]"), F.array().cast(TURNS)).otherwise(out)
        return out

    found = F.coalesce(record_paths(record), F.array().cast("array<string>"))
    return F.when(F.try_parse_json(record).isNotNull(), F.get(F.transform(F.array(found), mapped), F.lit(0)))


def _grouped(df: DataFrame) -> DataFrame:
    """conv_id, turns of one row for each turn."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    held = df.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return held.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def frame_turns(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """`key`, turns of a frame in any of the layouts, selected by the fingerprint of its schema."""
    found = set(paths(df.schema))
    for known, wanted, schema, made in _known():
        if fingerprint([p for p in wanted if p in found]) == known:
            if made is None:
                return _grouped(df)
            record = F.struct(*[F.col(f.name) for f in schema.fields])
            return df.select(*([key] if key in df.columns else []), made(record).cast(TURNS).alias("turns"))
    raise ValueError(f"no mapping for the field paths {sorted(found)}")


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        c = F.replace(c, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return c


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\\n"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


#: Sizes are summed up in groups of so many, so that a long conversation's offsets cost little more than its length.
GROUP = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda a, n: a + n)


def offsets(sizes: Column) -> Column:
    """The sum of the sizes before each."""
    groups = lambda s: F.transform(F.sequence(F.lit(0), (F.size(s) / GROUP).cast("int")), lambda g: _sum(F.slice(s, g * GROUP + 1, GROUP)))
    before = lambda s: _let(groups(s), lambda sums: F.transform(sums, lambda _, g: _sum(F.slice(sums, F.lit(1), g))))
    at = lambda s, held: F.transform(s, lambda _, i: F.get(held, (i / GROUP).cast("int")) + _sum(F.slice(s, (i / GROUP).cast("int") * GROUP + 1, i % GROUP)))
    return _let(sizes, lambda s: _let(before(s), lambda held: at(s, held)))


def formatted(turns: DataFrame) -> DataFrame:
    """`turns` with `formatted` and `loss`, in place of turns."""
    parts = F.transform("turns", lambda t: F.struct(F.concat(F.lit(BEGIN), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("learn")))
    out = turns.withColumn("__parts", parts)
    text = F.array_join(F.transform("__parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    begins = offsets(F.transform("__parts", lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END)))

    def span(z: Column) -> Column:
        begin = z["at"] + F.length(z["__parts"]["head"])
        return F.struct(begin.alias("start"), (begin + F.length(z["__parts"]["body"])).alias("end"))

    loss = F.transform(F.filter(F.arrays_zip("__parts", begins.alias("at")), lambda z: z["__parts"]["learn"]), span)
    return out.withColumn("formatted", text).withColumn("loss", loss).drop("turns", "__parts")


def parsed(df: DataFrame) -> DataFrame:
    """`df` with `turns`, read back from `formatted`, and `learned`, the text under the loss mask."""
    pieces = F.filter(F.split("formatted", END), lambda p: p != "")
    head = r"(?s)^<s>((?:[^\\\n]++|\\.)*+)\n(.*)$"
    turn = F.transform(pieces, lambda p: F.struct(unescape(F.regexp_extract(p, head, 1)).alias("role"), unescape(F.regexp_extract(p, head, 2)).alias("text")))
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return df.withColumn("turns", turn).withColumn("learned", F.array_join(learned, ""))


def digests(df: DataFrame) -> DataFrame:
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed(df).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS et,
  replace(replace(replace(replace(replace(replace(role, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), chr(10), '\' || chr(10)) AS er FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(er) + length(et) + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
