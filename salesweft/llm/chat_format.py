"""Chat formatting with a grammar round trip.

The grammar of a formatted conversation::

    conversation = turn*
    turn         = "### " role ": " text "</turn>\\n"

``parsed`` is its deterministic parser: it cuts at every ``"### "``, takes the
role up to the first colon, the text up to the first ``"</turn>"`` and undoes
the escapes ``\\\\h`` (#), ``\\\\l`` (<), ``\\\\c`` (:) and ``\\\\\\\\`` (backslash).

A conversation is rendered as it stands, parsed again and compared with its
source, turn by turn.  While they differ it is rendered at the next level:
level 1 escapes the control strings and the backslashes in texts, level 2
every character that an escape exists for.  A conversation that no level
brings back raises an error, so what is returned is proven to be reversible.
Roles are always escaped.

The loss mask is read back from the formatted text: the spans (code points,
end exclusive) of the texts of the trained role, as the parser finds them.

A conversation is one text, so its turns meet in one row; nothing else is
grouped.  Everything is a DataFrame expression.

Defined cases: a null text or role is empty; turns come by number, null numbers
last, ties by role, then text; repeated rows are turns of their own; rows with
a null id form one conversation with a null id; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesweft.llm.columns import let

HEAD, COLON, TAIL, END = "### ", ": ", "</turn>", "</turn>\n"
# Escapes of single characters; the backslash itself is doubled.
ESCAPES = {"#": "\\h", "<": "\\l", ":": "\\c"}
LEVELS = 3
CHUNK = 256
TURN = "struct<role:string,text:string>"
PARSED = "array<struct<role:string,text:string,written:string>>"


def _swap(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escaped(text: Column, level: int) -> Column:
    """The text as it is written at a level; level 0 writes it as it is."""
    if level == 0:
        return text
    text = _swap(text, "\\", "\\\\")
    if level == 1:
        return _swap(_swap(text, TAIL, ESCAPES["<"] + TAIL[1:]), HEAD, ESCAPES["#"] + HEAD[1:])
    for plain, code in ESCAPES.items():
        text = _swap(text, plain, code)
    return text


def unescaped(text: Column) -> Column:
    """What a written text stands for.

    Every backslash starts a pair, and no pair but the doubled one ends in a
    backslash, so cutting at doubled ones from the left never cuts a pair.
    """

    def undo(part: Column) -> Column:
        for plain, code in ESCAPES.items():
            part = _swap(part, code, plain)
        return part

    pairs = F.array_join(F.transform(F.split(text, r"\\\\", -1), undo), "\\")
    return F.when(F.contains(text, F.lit("\\")), pairs).otherwise(text)


def rendered(turns: Column, level: int) -> Column:
    """The formatted text of an array of (role, text)."""
    written = F.transform(turns, lambda t: F.concat(F.lit(HEAD), escaped(t["role"], LEVELS - 1), F.lit(COLON), escaped(t["text"], level), F.lit(END)))
    return F.array_join(written, "")


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text, written text).

    Null where the text is not of the grammar, so such a text equals nothing.
    """

    def turn(part: Column) -> Column:
        return let(F.struct(part.alias("part"), F.instr(part, COLON).alias("colon"), F.instr(part, TAIL).alias("tail")), cut)

    def cut(x: Column) -> Column:
        role = F.substring(x["part"], F.lit(1), x["colon"] - 1)
        body = F.substring(x["part"], x["colon"] + len(COLON), x["tail"] - x["colon"] - len(COLON))
        whole = (x["colon"] > 0) & (x["tail"] > x["colon"]) & F.endswith(x["part"], F.lit(END)) & (F.length(x["part"]) == x["tail"] + len(END) - 1)
        turn = let(body, lambda written: F.struct(unescaped(role).alias("role"), unescaped(written).alias("text"), written.alias("written")))
        return F.when(whole, turn)

    def turns(parts: Column) -> Column:
        found = F.transform(F.slice(parts, F.lit(2), F.greatest(F.lit(0), F.size(parts) - 1)), turn)
        return F.when(F.get(parts, F.lit(0)) == "", let(found, lambda x: F.when(~F.exists(x, lambda t: t.isNull()), x)))

    return let(F.split(formatted, HEAD, -1), turns)


def _same(source: Column, recovered: Column) -> Column:
    plain = F.transform(recovered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return F.coalesce(source == plain, F.lit(False))


def loss_spans(turns: Column, trained: str) -> Column:
    """Array of (start, end) of the trained role's written texts; sums run in chunks to stay near linear."""
    kind = "array<struct<start:bigint,end:bigint>>"
    fixed = len(HEAD) + len(COLON)

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + fixed + F.length(escaped(t["role"], LEVELS - 1))
        end = start + F.length(t["written"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(t["role"] == trained, F.concat(state["out"], span)).otherwise(state["out"]).alias("out"))

    def chunk(state: Column, first: Column, every: Column) -> Column:
        inner = F.aggregate(F.slice(every, first, F.lit(CHUNK)), F.struct(state["at"].alias("at"), F.array().cast(kind).alias("out")), step)
        return let(inner, lambda s: F.struct(s["at"].alias("at"), F.concat(state["out"], F.array(s["out"])).alias("out")))

    def spans(every: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        firsts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(every)), F.lit(CHUNK))
        return F.flatten(F.aggregate(firsts, zero, lambda state, first: chunk(state, first, every), lambda state: state["out"]))

    return let(turns, spans)


def conversations(rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """conv_id and its turns in order, as an array of (role, text)."""
    blank = F.lit("")
    place = F.struct(
        F.col(turn_column).isNull().alias("unknown"), F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), blank).alias("role"), F.coalesce(F.col(text_column), blank).alias("text"),
    )
    grouped = rows.select(F.col(id_column).alias("conv_id"), place.alias("place")).groupBy("conv_id").agg(F.sort_array(F.collect_list("place")).alias("places"))
    return grouped.select("conv_id", F.transform("places", lambda p: F.struct(p["role"].alias("role"), p["text"].alias("text"))).alias("source"))


def formatted(rows: DataFrame, trained: str = "assistant", **columns: str) -> DataFrame:
    """conv_id, formatted text, level, loss_spans and the turns (role, text, written) read back from the text."""
    kind = f"struct<level:int,formatted:string,turns:{PARSED}>"

    def attempt(source: Column, level: int) -> Column:
        if level == LEVELS:
            return F.raise_error(F.lit("a conversation does not come back from its formatted text")).cast(kind)
        text = rendered(source, level)
        tried = let(text, lambda t: F.struct(F.lit(level).alias("level"), t.alias("formatted"), parsed(t).alias("turns")))
        return let(tried, lambda x: F.when(_same(source, x["turns"]), x.cast(kind)).otherwise(attempt(source, level + 1)))

    found = conversations(rows, **columns).select("conv_id", let(F.col("source"), lambda s: attempt(s, 0)).alias("found"))
    return found.select("conv_id", "found.formatted", "found.level", loss_spans(F.col("found.turns"), trained).alias("loss_spans"), "found.turns")


def digests(rows: DataFrame, trained: str = "assistant", **columns: str) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, both read back from the formatted text."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = formatted(rows, trained, **columns)
    under = let(
        F.struct("formatted", "loss_spans"),
        lambda x: F.transform(x["loss_spans"], lambda s: unescaped(F.substring(x["formatted"], (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))),
    )
    masked = F.array_join(under, "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        let(masked, lambda text: F.struct(F.length(text).cast("long").alias("chars"), F.sha2(text, 256).alias("sha256"))).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select("conv_id", "n_turns", "turns_sha256", F.col("loss.chars").alias("loss_chars"), F.col("loss.sha256").alias("loss_sha256"), "formatted_chars")
