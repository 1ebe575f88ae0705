"""Secret scan through a trigram index.

From each rule's pattern a Boolean query over trigrams is derived: every text
the pattern matches must contain, for each mandatory part, all trigrams of at
least one of that part's strings.  The index holds postings (trigram,
document) of the trigrams that occur in any query, over lower-case text, and
is written to the shared folder.  A search intersects and unites postings by a
bit per trigram, and only the candidates are verified with the pattern itself.
A pattern without a mandatory trigram is run over all documents.

Spans are in code points, end exclusive.  Defined cases: a null text is empty
and has no spans; a null id is a key like any other; repeated rows get equal
results; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as parts
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesweft.llm.columns import let
from salesweft.session import written

MAX_STRINGS = 64
CHUNK = 256


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern, the group whose length counts, and the least length."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @property
    def regex(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


# A match of the hex and access patterns is a whole run of its class, so the
# least length can stand in the pattern itself.
BASE_RULES = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
MORE_RULES = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
RULES = BASE_RULES + MORE_RULES

Query = list[list[frozenset[str]]]


def mandatory_strings(pattern: str) -> list[set[str]]:
    """Sets of strings of which a match must hold at least one each, in lower case."""
    clauses: list[set[str]] = []

    def flush(strings: set[str]) -> set[str]:
        clauses.append(strings)
        return {""}

    def expand(items, strings: set[str], top: bool) -> set[str] | None:
        """The strings extended by the items; None when they are not finitely many."""
        for op, arg in items:
            options: set[str] | None = None
            if op is parts.LITERAL:
                options = {chr(arg).lower()}
            elif op is parts.IN and all(x[0] is parts.LITERAL for x in arg):
                options = {chr(x[1]).lower() for x in arg}
            elif op is parts.SUBPATTERN:
                options = expand(arg[-1], {""}, False)
            elif op is parts.BRANCH:
                found = [expand(branch, {""}, False) for branch in arg[1]]
                options = None if None in found else set().union(*found)
            elif op is parts.MAX_REPEAT and arg[0] == arg[1] == 1 or op is parts.MAX_REPEAT and (arg[0], arg[1]) == (0, 1):
                once = expand(arg[2], {""}, False)
                options = None if once is None else once | ({""} if arg[0] == 0 else set())
            if options is not None and len(options) * len(strings) <= MAX_STRINGS:
                strings = {a + b for a, b in product(strings, options)}
            elif not top:
                return None
            else:
                strings = flush(strings)
                if options is not None:
                    strings = set(options)
        return strings

    flush(expand(_parser.parse(pattern), {""}, True))
    return [c for c in clauses if c and all(len(s) >= 3 for s in c)]


def trigram_query(pattern: str) -> Query:
    """AND over mandatory parts of OR over strings of AND over trigrams; empty: no mandatory trigram."""
    out = []
    for clause in mandatory_strings(pattern):
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in clause}
        out.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))
    return out


def needed_trigrams(rules: list[Rule]) -> list[str]:
    """All trigrams that occur in a query of the rules, in fixed order."""
    return sorted({t for rule in rules for clause in trigram_query(rule.pattern) for s in clause for t in s})


def _key(id_column: str, text_column: str) -> list[Column]:
    return [F.col(id_column).alias("id"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("h")]


def build_index(docs: DataFrame, rules: list[Rule] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Postings (trigram number, id, text hash), written to the shared folder."""
    names = needed_trigrams(rules)
    low = F.lower(F.coalesce(F.col(text_column), F.lit("")))
    present = docs.select(*_key(id_column, text_column), low.alias("low")).select(
        "id", "h", F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(names)])).alias("found")
    )
    # The outer form keeps Spark from computing the array twice, for a filter and for the rows.
    postings = present.select("id", "h", F.explode_outer("found").alias("trigram")).where("trigram IS NOT NULL")
    return written(postings, "trigram-postings")


def candidates(postings: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per document key the rules whose query its postings satisfy (bit i: rule i)."""
    names = {t: i for i, t in enumerate(needed_trigrams(rules))}
    words = -(-max(1, len(names)) // 60)
    bits = [
        F.bit_or(F.when(F.floor(F.col("trigram") / 60) == w, F.expr("shiftleft(1L, pmod(trigram, 60))")).otherwise(F.lit(0).cast("long"))).alias(f"m{w}")
        for w in range(words)
    ]
    seen = postings.groupBy("id", "h").agg(*bits)

    def has(trigrams: frozenset[str]) -> Column:
        masks = [sum(1 << (names[t] % 60) for t in trigrams if names[t] // 60 == w) for w in range(words)]
        return reduce(lambda a, b: a & b, [F.col(f"m{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in enumerate(masks) if m])

    flags = []
    for i, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query:
            holds = reduce(lambda a, b: a & b, [reduce(lambda a, b: a | b, [has(s) for s in clause]) for clause in query])
            flags.append(F.when(holds, F.lit(1 << i)).otherwise(F.lit(0)))
    mask = reduce(lambda a, b: a.bitwiseOR(b), flags) if flags else F.lit(0)
    return seen.select("id", "h", mask.alias("rules")).where("rules > 0")


def span_array(text: Column, rule: Rule, order: int) -> Column:
    """The rule's spans in a text: array of (start, order, end).

    The parts between the matches and the matches alternate, so running sums
    of their lengths are the positions.  The sums run in chunks, which keeps
    the cost near linear in the number of matches.
    """
    regex = F.lit(rule.regex)
    pieces = F.zip_with(
        F.split(text, rule.regex, -1),
        F.zip_with(F.regexp_extract_all(text, regex, F.lit(0)), F.regexp_extract_all(text, regex, F.lit(rule.group)), lambda m, g: F.struct(F.length(m).alias("m"), F.length(g).alias("g"))),
        lambda gap, x: F.struct(F.length(gap).alias("gap"), F.coalesce(x["m"], F.lit(-1)).alias("m"), F.coalesce(x["g"], F.lit(-1)).alias("g")),
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), (start + x["m"]).alias("end"))
        return F.struct(
            (start + F.greatest(x["m"], F.lit(0))).alias("at"),
            F.when((x["m"] >= 0) & (x["g"] >= rule.least), F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"),
        )

    def chunk(state: Column, first: Column, all_pieces: Column) -> Column:
        inner = F.aggregate(F.slice(all_pieces, first, F.lit(CHUNK)), F.struct(state["at"].alias("at"), empty.alias("out")), step)
        return let(inner, lambda s: F.struct(s["at"].alias("at"), F.concat(state["out"], F.array(s["out"])).alias("out")))

    return let(
        pieces,
        lambda p: F.flatten(
            F.aggregate(
                F.sequence(F.lit(1), F.size(p), F.lit(CHUNK)),
                F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,kind:int,end:int>>>").alias("out")),
                lambda state, first: chunk(state, first, p),
                lambda state: state["out"],
            )
        ),
    )


def scanned(docs: DataFrame, rules: list[Rule] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document its id and all verified spans, sorted: array of (start, kind number, end)."""
    found = written(candidates(build_index(docs, rules, id_column, text_column), rules), "trigram-candidates")
    texts = docs.select(*_key(id_column, text_column), F.coalesce(F.col(text_column), F.lit("")).alias("t"))
    marked = texts.join(
        found.withColumnsRenamed({"id": "cid", "h": "ch"}), (F.col("h") == F.col("ch")) & F.col("id").eqNullSafe(F.col("cid")), "left"
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    arrays = []
    for i, rule in enumerate(rules):
        spans = span_array(F.col("t"), rule, i)
        if trigram_query(rule.pattern):
            arrays.append(F.when(F.col("rules").bitwiseAND(F.lit(1 << i)) > 0, spans).otherwise(empty))
        else:
            arrays.append(F.when(F.col("t").rlike(rule.regex), spans).otherwise(empty))
    return marked.select(F.col("id").alias("doc_id"), F.sort_array(F.concat(*arrays)).alias("spans"))


def joined(spans: Column, rules: list[Rule]) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def secret_counts(docs: DataFrame, more_rules: list[Rule] = MORE_RULES, **columns: str) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    rules = BASE_RULES + list(more_rules)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))
    return scanned(docs, rules, **columns).select(
        "doc_id",
        *[_count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(BASE_RULES)],
        F.sha2(joined(base, rules), 256).alias("base_sha256"),
        joined(F.col("spans"), rules).alias("spans"),
    )
