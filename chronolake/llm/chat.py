"""Chat formatting: records of different layouts become canonical turns, then one training text each.

Records sit in one table whose columns are the union of all layouts (what ``spark.read.json`` makes of mixed
lines); a record's layout shows in the nested fields that it fills. Their paths are hashed into a fingerprint,
and the fingerprint selects the declarative mapping that names where roles and texts are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

TURN = "struct<role:string,text:string>"


@dataclass(frozen=True)
class Flat:
    """One field for each turn: (role, fields); several fields are joined by line feeds."""

    turns: tuple[tuple[str, tuple[str, ...]], ...]

    def paths(self) -> list[str]:
        return [f for _, fields in self.turns for f in fields]

    def build(self) -> Column:
        made = [
            F.struct(F.lit(role).alias("role"), F.concat_ws("\n", *[F.col(f) for f in fields]).alias("text"))
            for role, fields in self.turns
        ]
        return F.array(*made)


@dataclass(frozen=True)
class Listed:
    """An array of messages; ``names`` maps the layout's role names to canonical ones, others stay."""

    array: str
    role: str
    text: str
    names: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> list[str]:
        return [f"{self.array}[].{self.role}", f"{self.array}[].{self.text}"]

    def build(self) -> Column:
        def one(m: Column) -> Column:
            role = F.coalesce(m[self.role], F.lit(""))
            named = role
            for old, new in self.names.items():
                named = F.when(role == old, F.lit(new)).otherwise(named)
            return F.struct(named.alias("role"), F.coalesce(m[self.text], F.lit("")).alias("text"))

        return F.transform(F.col(self.array), one)


#: Layouts known from the start; callers may pass more.
MAPPINGS: dict[str, Flat | Listed] = {
    "messages": Listed("messages", "role", "content"),
    "from_value": Listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    "prompt": Flat((("user", ("prompt",)), ("assistant", ("completion",)))),
    "instruction": Flat((("user", ("instruction",)), ("assistant", ("output",)))),
    "instruction_input": Flat((("user", ("instruction", "input")), ("assistant", ("output",)))),
    "instruction_system": Flat((("system", ("system",)), ("user", ("instruction",)), ("assistant", ("output",)))),
}


def fingerprint_of(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprint(schema: StructType, ignore: tuple[str, ...] = ()) -> Column:
    """SHA-256 over the sorted paths of the nested fields that a row fills; ``ignore`` names top columns left out."""
    present: list[tuple[str, Column]] = []

    def filled(name: str):
        return lambda x: x[name].isNotNull()

    def walk(kind, path: str, get) -> None:
        if isinstance(kind, StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}", lambda row, g=get, n=f.name: g(row)[n])
        elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
            for f in kind.elementType.fields:
                present.append((f"{path}[].{f.name}", F.exists(get(None), filled(f.name))))
        else:
            present.append((path, get(None).isNotNull()))

    for f in schema.fields:
        if f.name not in ignore:
            walk(f.dataType, f.name, lambda _, n=f.name: F.col(f"`{n}`"))
    found = [F.when(F.coalesce(there, F.lit(False)), F.lit(path)) for path, there in sorted(present, key=lambda x: x[0])]
    return F.sha2(F.concat_ws("\n", *found) if found else F.lit(""), 256)


def canonical(records: DataFrame, ignore: tuple[str, ...], mappings: dict[str, Flat | Listed] | None = None) -> DataFrame:
    """Adds ``layout`` and ``turns`` (array of role and text); both null where no mapping has the fingerprint.

    Missing columns of a mapping only mean that no record has its layout. Null roles and texts inside a
    message are empty.
    """
    chosen = {n: m for n, m in (mappings or MAPPINGS).items() if {p.split("[")[0] for p in m.paths()} <= set(records.columns)}
    known = records.withColumn("_print", fingerprint(records.schema, ignore))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    for name, m in chosen.items():
        same = F.col("_print") == fingerprint_of(m.paths())
        layout = F.when(same, F.lit(name)).otherwise(layout)
        turns = F.when(same, m.build().cast(f"array<{TURN}>")).otherwise(turns)
    return known.withColumns({"layout": layout, "turns": turns}).drop("_print")


# The template: <s>role, line feed, text, </s>; what isn't the assistant's stands between [INST] and [/INST].
OPEN, CLOSE, ASK, ASKED = "<s>", "</s>", "[INST] ", " [/INST]"
#: A control string in a text gets a backslash after its bracket, one more than it had.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
ROLE_ESCAPES = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("[", "%5B"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    for plain, coded in ROLE_ESCAPES:
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def unescape_role(role: Column) -> Column:
    for plain, coded in reversed(ROLE_ESCAPES):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return role


def format_turns(df: DataFrame) -> DataFrame:
    """Adds ``formatted`` and ``loss``: for each turn, where in its part of the text the loss counts (start, length).

    Only the assistant's words bear loss; other turns have length 0.
    """

    def part(t: Column) -> Column:
        own = t["role"] == "assistant"
        text = escape(t["text"])
        return F.concat(
            F.lit(OPEN),
            escape_role(t["role"]),
            F.lit("\n"),
            F.when(own, text).otherwise(F.concat(F.lit(ASK), text, F.lit(ASKED))),
            F.lit(CLOSE),
        )

    def span(t: Column) -> Column:
        own = t["role"] == "assistant"
        return F.struct(
            (F.length(escape_role(t["role"])) + len(OPEN) + 1).cast("long").alias("start"),
            F.when(own, F.length(escape(t["text"]))).otherwise(0).cast("long").alias("length"),
        )

    return df.withColumns({"formatted": F.array_join(F.transform("turns", part), ""), "loss": F.transform("turns", span)})


def read_back(df: DataFrame) -> DataFrame:
    """Adds ``read_turns`` and ``read_loss`` (the unescaped texts under the loss mask), from ``formatted`` and ``loss`` alone."""
    parts = F.split(F.col("formatted"), CLOSE, -1)
    df = df.withColumn("_parts", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        rest = F.substr(p, F.length(role) + 2)
        inner = F.substr(rest, F.lit(len(ASK) + 1), F.length(rest) - len(ASK) - len(ASKED))
        text = F.when(role == F.lit(OPEN + "assistant"), rest).otherwise(inner)
        return F.struct(unescape_role(F.substr(role, F.lit(len(OPEN) + 1))).alias("role"), unescape(text).alias("text"))

    def under(x: Column) -> Column:
        return unescape(F.substr(x["_parts"], (x["loss"]["start"] + 1).cast("int"), x["loss"]["length"].cast("int")))

    return df.withColumns(
        {"read_turns": F.transform("_parts", turn), "read_loss": F.array_join(F.transform(F.arrays_zip("_parts", "loss"), under), "")}
    ).drop("_parts")


def records_of(rows: DataFrame) -> DataFrame:
    """One record for each conv_id of rows (conv_id, turn, role, text), in the layout that its turns fit.

    Turns go by turn (null first), then role and text; null roles and texts are empty. A question and its
    answer become prompt and completion, one with a system text an instruction; of the rest, conversations
    of known roles and an odd conv_id take the from/value layout, and all others the messages layout. A
    conversation is one record, so its turns do meet in one row.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    df = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.transform("t", lambda x: x["role"])
    known = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    odd = F.pmod(F.coalesce(F.col("conv_id").cast("long"), F.lit(0)), F.lit(2)) == 1
    df = df.withColumn(
        "as",
        F.when(roles == F.array(F.lit("user"), F.lit("assistant")), "prompt")
        .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), "instruction")
        .when(known & odd, "from")
        .otherwise("messages"),
    )

    def text(kind: str, i: int) -> Column:
        return F.when(F.col("as") == kind, F.get("t", F.lit(i))["text"])

    def said(x: Column) -> Column:
        role = F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"])
        return F.struct(role.alias("from"), x["text"].alias("value"))

    return df.select(
        "conv_id",
        text("prompt", 0).alias("prompt"),
        text("prompt", 1).alias("completion"),
        text("instruction", 0).alias("system"),
        text("instruction", 1).alias("instruction"),
        text("instruction", 2).alias("output"),
        F.when(F.col("as") == "from", F.transform("t", said)).alias("conversations"),
        F.when(
            F.col("as") == "messages",
            F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))),
        ).alias("messages"),
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, layout, turns, formatted and loss of every conversation of rows (conv_id, turn, role, text).

    A null conv_id is a conversation of its own; repeated rows are repeated turns; other columns are not
    read; an empty table gives no rows.
    """
    return format_turns(canonical(records_of(rows), ("conv_id",))).select("conv_id", "layout", "turns", "formatted", "loss")


def digest(formatted: DataFrame) -> DataFrame:
    """What reading the formatted texts back gives: turn count and hashes, loss and length."""
    return read_back(formatted).select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("read_loss").cast("long").alias("loss_chars"),
        F.sha2("read_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
