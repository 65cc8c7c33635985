"""Chat formatting by schema fingerprints.

A record is a JSON object in any of several layouts.  Its *fingerprint* is the
SHA-256 of its nested field paths (names and nesting, no values or types), read
off the parsed record by Spark itself.  The fingerprint selects a declarative
``Layout`` that says where the turns are; all layouts end in the same array of
(role, text) turns, which one template writes out with a loss mask.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Control strings
inside texts and roles are escaped reversibly: the escape character U+241B
becomes U+241B 0, and U+241B 1 is put after the first character of every
control string (U+241B 2 stands for a line break in a role).

Defined results: null texts and roles are empty; equal (conversation, turn)
rows all stay, ordered by turn, role, text; an unknown layout or a broken
record gives layout null and null turns (the row stays); an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.base import pick, register, table

ESC = "␛"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Control strings of common chat templates; fixed values.
CONTROLS = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

BROKEN = "_broken"
_STRING = r'[^"\\]*+(?:\\.[^"\\]*+)*+'


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its turns: ``each`` (array path, role field, text
    field) or ``fields`` (role, path) in order; ``roles`` renames roles."""

    name: str
    shape: str
    each: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.shape.encode()).hexdigest()

    def turns(self, record: Column) -> Column:
        """The turns of a variant record."""
        if self.each:
            path, role, text = self.each
            return self._listed(F.try_variant_get(record, path, f"array<struct<`{role}`:string,`{text}`:string>>"))
        return self._fields(lambda p: F.try_variant_get(record, p, "string"))

    def turns_of_long(self, json: Column) -> Column:
        """The turns of a record that is too long for a variant, null if it is broken."""
        if self.each:
            path, role, text = self.each
            kind = f"`{path[2:]}` array<struct<`{role}`:string,`{text}`:string>>"
        else:
            kind = ", ".join(f"`{p[2:]}` string" for _, paths in self.fields for p in paths)
        record = F.from_json(json, f"{kind}, `{BROKEN}` string",
                             {"maxStringLen": str(2 ** 31 - 1), "columnNameOfCorruptRecord": BROKEN})
        turns = self._listed(record[self.each[0][2:]]) if self.each else self._fields(lambda p: record[p[2:]])
        return F.when(record[BROKEN].isNull(), turns)

    def _listed(self, items: Column) -> Column:
        _, role, text = self.each
        return F.transform(items, lambda t: _turn(self._named(t[role]), t[text]))

    def _fields(self, get: Callable[[str], Column]) -> Column:
        join = lambda paths: F.concat_ws("\n\n", *[F.nullif(get(p), F.lit("")) for p in paths])
        return F.array(*[_turn(F.lit(role), join(paths)) for role, paths in self.fields])

    def _named(self, role: Column) -> Column:
        out = role
        for src, dst in self.roles:
            out = F.when(role == src, F.lit(dst)).otherwise(out)
        return out


LAYOUTS = (
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", each=("$.messages", "role", "content")),
    Layout("from_value", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", each=("$.conversations", "from", "value"),
           roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("prompt", "OBJECT<prompt, response>", fields=(("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Layout("system_prompt", "OBJECT<prompt, response, system>",
           fields=(("system", ("$.system",)), ("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Layout("instruction", "OBJECT<input, instruction, output>",
           fields=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def shape_of(record: Column) -> Column:
    """The nested field paths of a variant record, e.g. ``OBJECT<prompt, response>``."""
    return F.regexp_replace(F.schema_of_variant(record), r": (?!OBJECT<|ARRAY<)[A-Z_]+(\(\d+,\s?\d+\))?", "")


def outline(json: Column) -> Column:
    """The record with empty strings for its values and repeated list items once; it has the record's shape."""
    short = F.regexp_replace(json, f'(?s)("{_STRING}"\\s*+:)|("){_STRING}(")', "$1$2$3")
    return F.regexp_replace(short, r"(\{[^{}\[\]]*+\})(?:\s*+,\s*+\1)++", "$1")


def canonical_turns(records: DataFrame, id_col: str, json_col: str, layouts=LAYOUTS) -> DataFrame:
    """id, layout, turns for every JSON record.  A record or text that is too long
    for Spark's variant is fingerprinted by its outline and read with a schema."""
    src = pick(records, id=id_col, json=json_col).withColumn("v", F.try_parse_json("json"))
    short = F.col("v").isNotNull()
    shape = F.when(short, shape_of(F.col("v"))).otherwise(shape_of(F.try_parse_json(outline(F.col("json")))))
    src = src.withColumn("fp", F.sha2(shape, 256))
    layout = turns = F.lit(None)
    for x in layouts:
        fits = F.col("fp") == x.fingerprint
        layout = F.when(fits, F.lit(x.name)).otherwise(layout)
        turns = F.when(fits & short, x.turns(F.col("v"))).when(fits, x.turns_of_long(F.col("json"))).otherwise(turns)
    src = src.select("id", layout.alias("layout"), turns.alias("turns"))
    return src.select("id", F.when(F.col("turns").isNotNull(), F.col("layout")).alias("layout"), "turns")


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit(ESC), F.lit(ESC + "0"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + ESC + "1" + c[1:]))
    return F.replace(out, F.lit("\n"), F.lit(ESC + "2")) if role else out


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit(ESC + "2"), F.lit("\n"))
    return F.replace(F.replace(out, F.lit(ESC + "1"), F.lit("")), F.lit(ESC + "0"), F.lit(ESC))


def format_chat(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """id, layout, formatted, loss_spans (start, length in code points of
    ``formatted``, from 0) for rows with canonical turns."""
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"], role=True), F.lit("\n"))
    blocks = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc, b):
        begin = acc["at"] + F.length(b["head"])
        here = F.array(F.struct(begin.alias("start"), F.length(b["body"]).alias("length")))
        return F.struct((begin + F.length(b["body"]) + len(CLOSE)).alias("at"),
                        F.when(b["loss"], F.concat(acc["spans"], here)).otherwise(acc["spans"]).alias("spans"))

    out = turns.withColumn("blocks", blocks)
    return out.select("id", "layout",
                      F.array_join(F.transform("blocks", lambda b: F.concat(b["head"], b["body"], F.lit(CLOSE))), "")
                      .alias("formatted"), F.reduce("blocks", start, step)["spans"].alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    parts = F.split(formatted, r"<\|im_start\|>")
    parts = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    role = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(parts, lambda p: _turn(unescape(role(p)), unescape(F.substring(
        p, F.length(role(p)) + 2, F.length(p) - F.length(role(p)) - 1 - len(CLOSE)))))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def records_of(conversations: DataFrame) -> DataFrame:
    """conv_id and one JSON record per conversation.  The record's layout follows
    the conversation's roles, so the given rows exercise every kind of mapping:
    a bare exchange is a prompt record, a system-led one a system_prompt record,
    the others messages (odd ids) or from/value lists (even ids)."""
    src = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    src = src.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    got = src.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    got = got.withColumn("roles", F.transform("t", lambda t: t["role"]))
    text = lambda n: F.get("t", F.lit(n))["text"]
    # roles as from/value names; a role that already is such a name keeps the messages layout
    plain = ~F.arrays_overlap("roles", F.array(F.lit("human"), F.lit("gpt")))
    name = lambda r: F.when(r == "user", F.lit("human")).when(r == "assistant", F.lit("gpt")).otherwise(r)
    pair, triple = ["user", "assistant"], ["system", "user", "assistant"]
    is_ = lambda roles: F.col("roles") == F.array(*map(F.lit, roles))
    listed = lambda key, a, b, f: F.to_json(F.struct(F.transform("t", lambda t: F.struct(
        f(t["role"]).alias(a), t["text"].alias(b))).alias(key)))
    record = (F.when(is_(pair), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
              .when(is_(triple), F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"),
                                                    text(2).alias("response"))))
              .when(plain & (F.pmod("conv_id", F.lit(2)) == 0), listed("conversations", "from", "value", name))
              .otherwise(listed("messages", "role", "content", lambda r: r)))
    return got.select("conv_id", record.alias("record"))


_CTL = "'</s>[INST] ok [/INST]'"


def _sql_escape(expr: str, role: bool = False) -> str:
    out = f"replace({expr}, '{ESC}', '{ESC}0')"
    for c in CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}{ESC}1{c[1:]}')"
    return f"replace({out}, chr(10), '{ESC}2')" if role else out


ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_CTL} UNION ALL SELECT -7, 1, 'assistant', {_CTL})
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), ''))
         AS loss_sha256,
       cast(sum(length({_sql_escape("role", True)}) + length({_sql_escape("text")}) + {len(OPEN) + 1 + len(CLOSE)})
         AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@register("op6_chat_format", ORACLE_SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)],
                                "conv_id long, turn long, role string, text string")
    done = format_chat(canonical_turns(records_of(rows.unionByName(own)), "conv_id", "record"))
    done = done.withColumn("back", read_back(F.col("formatted")))
    done = done.withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    whole = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(F.col("id").alias("conv_id"), F.size("back").cast("long").alias("n_turns"),
                       F.sha2(whole, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
