import hashlib
import random

import pytest
from pyspark.sql import functions as F

from salesweft.llm import chat_format, queries

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, level int, source string, places int, found string"
PIECES = ["\\", "#", "##", "### ", "###", "</turn>", "</turn>\n", "<", ": ", ":", "\\h", "\\l", "\\c", "\\\\", "\n", " ", "a", "é", "😀", "assistant"]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "f", 1, "s", 2, "x") for r in rows], SCHEMA).repartition(parts)


def conversations(seed=1):
    rng = random.Random(seed)
    mixed = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", mixed()]), mixed()) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(100, None, "assistant", "last"), (100, 0, None, None), (100, 0, "assistant", ""), (100, 1, "assistant", "é" * 200_000)]
    rows += [(101, 1, "assistant", "twice"), (101, 1, "assistant", "twice"), (101, 1, "", "tie"), (None, 0, "assistant", "no id"), (None, 1, "user", None)]
    rows += [(102, t, "assistant" if t % 2 else "user", f"turn {t} ### ") for t in range(700)]
    rows += [(-7, t, r, queries.MARKED) for t, r in enumerate(["user", "assistant"])]
    return rows


def ordered(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def plain_parse(text):
    """The grammar once more, one character at a time."""
    turns, at = [], 0
    undo = {"h": "#", "l": "<", "c": ":", "\\": "\\"}

    def until(mark, at):
        out = ""
        while not text.startswith(mark, at):
            if text[at] == "\\" and text[at + 1] in undo:
                out, at = out + undo[text[at + 1]], at + 2
            else:
                out, at = out + text[at], at + 1
        return out, at + len(mark)

    while at < len(text):
        assert text.startswith("### ", at)
        role, at = until(": ", at + 4)
        said, at = until("</turn>\n", at)
        turns.append((role, said))
    return turns


def test_round_trip_and_mask(spark):
    rows = conversations()
    want = ordered(rows)
    found = chat_format.formatted(frame(spark, rows)).collect()
    assert len(found) == len(want)
    for r in found:
        source = want[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == source
        assert plain_parse(r.formatted) == source
        assert r.formatted.count("### ") == r.formatted.count("</turn>") == len(source)
        under = [r.formatted[s.start : s.end] for s in r.loss_spans]
        assert under == [t.written for t in r.turns if t.role == "assistant"]
    levels = {r.conv_id: r.level for r in found}
    assert levels[-7] == 1 and levels[101] == 0


def test_digests(spark):
    rows = conversations(2)
    want = ordered(rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in chat_format.digests(frame(spark, rows)).collect():
        source = want[r.conv_id]
        loss = "".join(t for role, t in source if role == "assistant")
        assert r.n_turns == len(source) and r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in source))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars > loss.count("")


@pytest.mark.parametrize("level", [0, 1, 2])
def test_escapes(spark, level):
    rng = random.Random(level)
    texts = ["".join(rng.choice(PIECES) for _ in range(12)) for _ in range(300)]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat_format.escaped(F.col("t"), level).alias("e")).select("*", chat_format.unescaped(F.col("e")).alias("u")).collect()
    for r in out:
        assert level == 0 and r.e == r.t or level and r.u == r.t
        assert level == 0 or "### " not in r.e and "</turn>" not in r.e


@pytest.mark.parametrize("text", ["x", "### user: a", "### user: a</turn>", "### user: a</turn>\nb", "a### user: a</turn>\n", "### user</turn>\n", "### a: b</turn>c</turn>\n"])
def test_other_texts_are_not_parsed(spark, text):
    assert spark.range(1).select(chat_format.parsed(F.lit(text)).alias("p")).first().p is None


def test_empty_table(spark):
    empty = frame(spark, conversations()).limit(0)
    assert chat_format.formatted(empty).count() == 0 and chat_format.digests(empty).count() == 0


def test_no_python(spark):
    plan = chat_format.digests(frame(spark, conversations()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
