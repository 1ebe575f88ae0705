"""Quality rules: plain counts, and divergence from language references.

The counts are exact and whole-text.  The verdict compares two histograms of a
document, the share of characters per class and the share of words per common
word, with those of reference languages by Jensen-Shannon distance (square
root of the divergence in bits, 0 to 1).  A document passes when, for at least
one language, both distances stay below their limits.  Short histograms say
little, so each comparison has a least length below which it abstains.

Defined cases: a null text is empty; an empty text has no words and fails the
base rule; a document of unknown language is compared with all references;
without references every document passes the comparison, and so does a document
whose language has none (no document of ``min_chars``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesweft.llm.columns import BLANKS, let, words
from salesweft.session import written

SYMBOLS = "#*$%&|<>"

# Character classes by pattern.  Blanks and characters beyond ASCII follow from
# lengths; everything else, mostly lower-case letters, is the last class.
CLASSES: dict[str, str] = {"upper": "A-Z", "digit": "0-9", "stop": r".,;:'\x22()?-", "mark": r"!#*$%&|<>@=+_/\\^~{}\[\]`"}
HISTOGRAM = [*CLASSES, "blank", "wide", "rest"]


@dataclass(frozen=True)
class Limits:
    """Least lengths and greatest distances of the comparison."""

    min_words: int = 50
    repeat_percent: int = 50
    min_chars: int = 200
    min_common: int = 20
    max_class_distance: float = 0.30
    max_word_distance: float = 0.65
    common_words: int = 12


def base_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *keep: Column) -> DataFrame:
    """Word, symbol, line and repetition counts of every document."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    plain = docs.select(F.col(id_column).alias("doc_id"), text.alias("t"), words(text).alias("w"), *keep)
    more = [c for c in plain.columns if c not in ("doc_id", "t", "w")]
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    windows = let(
        F.col("w"),
        lambda w: F.transform(
            F.slice(w, F.lit(1), F.greatest(F.lit(0), F.size(w) - 2)),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
        ),
    )
    counted = plain.select(
        "doc_id",
        *more,
        "t",
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]++", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        windows.alias("h"),
    )
    # Most texts repeat no window; only the others are sorted.
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    placed = F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    counted = counted.select("*", F.when(repeats, F.sort_array(placed)).otherwise(none).alias("s"))
    # Windows in hash order: a window is repeated when a neighbour has the same hash.
    same = lambda s, i, x: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
    repeated = let(F.col("s"), lambda s: F.filter(s, lambda x, i: same(s, i - 1, x) | same(s, i + 1, x)))
    places = counted.select("*", F.sort_array(F.transform(repeated, lambda x: x["i"])).alias("p"))
    covered = F.aggregate(
        F.col("p"),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return places.select(
        "doc_id", *more, "t", "w", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.cast("long").alias("n_repeat_words")
    )


def class_counts(text: Column, word_chars: Column) -> Column:
    """Characters per class of :data:`HISTOGRAM`, as an array of doubles."""
    size = F.length(text)
    found = [F.length(F.regexp_replace(text, f"[^{c}]++", "")) for c in CLASSES.values()]
    blank, wide = size - word_chars, F.octet_length(text) - size
    rest = F.greatest(F.lit(0), size - blank - wide - reduce(lambda x, y: x + y, found))
    return F.array(*[x.cast("double") for x in (*found, blank, wide, rest)])


def common_counts(word_array: Column, vocabulary: list[str]) -> Column:
    """How often each vocabulary word stands in the words, as an array of doubles."""
    if not vocabulary:
        return F.array().cast("array<double>")
    # Lower, capitalised and upper-case forms are looked up, so only the words found are lower-cased.
    forms = sorted({f for v in vocabulary for f in (v, v.capitalize(), v.upper())})
    found = F.filter(word_array, lambda w: w.isin(forms))
    terms = F.array(*[F.lit(v) for v in vocabulary])
    spaced = F.concat(F.lit(" "), F.lower(F.array_join(found, "  ")), F.lit(" "))
    return let(
        spaced,
        lambda s: F.transform(terms, lambda v: ((F.length(s) - F.length(F.replace(s, F.concat(F.lit(" "), v, F.lit(" ")), F.lit("")))) / (F.length(v) + 2)).cast("double")),
    )


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)


def _share(counts: Column, total: Column) -> Column:
    return let(
        F.struct(counts.alias("counts"), total.alias("total")),
        lambda s: F.transform(s["counts"], lambda x: F.when(s["total"] > 0, x / s["total"]).otherwise(F.lit(0.0))),
    )


def distance(share: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of a share array from a fixed reference, rounded to 9 places."""
    log = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(share, F.array(*[F.lit(float(q)) for q in reference]), lambda p, q: log(p, (p + q) / 2) + log(q, (p + q) / 2))
    return F.round(F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2)), 9)


@dataclass(frozen=True)
class References:
    """Shares per language over the classes and over one common vocabulary."""

    vocabulary: list[str]
    classes: dict[str, list[float]]
    common: dict[str, list[float]]


def vocabulary(docs: DataFrame, limits: Limits = Limits(), text_column: str = "text", language: str = "lang") -> list[str]:
    """The ``common_words`` most frequent words of every language, over all its documents."""
    texts = docs.where(F.col(language).isNotNull() & (F.length(text_column) >= limits.min_chars))
    parts = F.split(F.translate(F.lower(text_column), BLANKS, " " * len(BLANKS)), " ", -1)
    seen = texts.select(F.col(language).alias("lang"), F.explode(parts).alias("w")).where("w != ''").groupBy("lang", "w").agg(F.count("*").alias("n"))
    ranked = seen.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))).where(F.col("place") <= limits.common_words)
    return sorted({r["w"] for r in ranked.select("w").collect()})


def measured(docs: DataFrame, terms: list[str], id_column: str = "doc_id", text_column: str = "text", language: str = "lang") -> DataFrame:
    """Counts, histograms and language of every document, without its text."""
    lang = F.col(language) if language in docs.columns else F.lit(None).cast("string")
    return base_counts(docs, id_column, text_column, lang.alias("lang")).select(
        "*", F.length("t").alias("n_chars"), class_counts(F.col("t"), F.col("word_chars")).alias("c"), common_counts(F.col("w"), terms).alias("v")
    ).drop("t", "w")


def summed(counts: DataFrame, terms: list[str], limits: Limits = Limits()) -> References:
    """References from the histograms of :func:`measured`; what is collected grows with the number of languages only."""
    long = counts.where(F.col("lang").isNotNull() & (F.col("n_chars") >= limits.min_chars))
    sums = long.select("lang", F.posexplode(F.concat("c", "v"))).groupBy("lang", "pos").agg(F.sum("col").alias("n")).collect()
    found: dict[str, list[float]] = {}
    for r in sums:
        found.setdefault(r["lang"], [0.0] * (len(HISTOGRAM) + len(terms)))[r["pos"]] = r["n"]

    def shares(values: list[float]) -> list[float]:
        return [x / (sum(values) or 1.0) for x in values]

    n = len(HISTOGRAM)
    return References(terms, {k: shares(v[:n]) for k, v in found.items()}, {k: shares(v[n:]) for k, v in found.items()})


def language_references(docs: DataFrame, limits: Limits = Limits(), id_column: str = "doc_id", text_column: str = "text", language: str = "lang") -> References:
    """References of every language, from all its documents of ``min_chars``."""
    terms = vocabulary(docs, limits, text_column, language)
    return summed(measured(docs, terms, id_column, text_column, language), terms, limits)


def judged(docs: DataFrame, references: References, limits: Limits = Limits(), id_column: str = "doc_id", text_column: str = "text", language: str = "lang") -> DataFrame:
    """Counts, distances to the nearest language and the verdict, per document."""
    return verdicts(measured(docs, references.vocabulary, id_column, text_column, language), references, limits)


def verdicts(base: DataFrame, references: References, limits: Limits = Limits()) -> DataFrame:
    """The same, from the rows of :func:`measured`."""
    totals = base.select("*", _total(F.col("c")).alias("n_classed"), _total(F.col("v")).alias("n_common"))
    shared = totals.select("*", _share(F.col("c"), F.col("n_classed")).alias("cs"), _share(F.col("v"), F.col("n_common")).alias("vs"))
    class_guard, word_guard = F.col("n_chars") < limits.min_chars, F.col("n_common") < limits.min_common
    languages = sorted(references.classes)
    near = [
        F.struct(distance(F.col("cs"), references.classes[name]).alias("c"), distance(F.col("vs"), references.common[name]).alias("v"))
        for name in languages
    ]
    per = shared.select("*", (F.array(*near) if near else F.array().cast("array<struct<c:double,v:double>>")).alias("ds"))
    fits = (
        F.when(class_guard & word_guard, F.lit(True))
        .when(class_guard, F.exists("ds", lambda d: d["v"] <= limits.max_word_distance))
        .when(word_guard, F.exists("ds", lambda d: d["c"] <= limits.max_class_distance))
        .otherwise(F.exists("ds", lambda d: (d["c"] <= limits.max_class_distance) & (d["v"] <= limits.max_word_distance)))
    )
    foreign = F.col("lang").isNotNull() & ~F.col("lang").isin(languages)
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    return per.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ((F.size("ds") == 0) | foreign | fits)).alias("kept"),
        F.when(~class_guard, F.array_min(F.transform("ds", lambda d: d["c"]))).alias("class_distance"),
        F.when(~word_guard, F.array_min(F.transform("ds", lambda d: d["v"]))).alias("word_distance"),
    )


def quality_rules(docs: DataFrame, limits: Limits = Limits(), **columns: str) -> DataFrame:
    """Fit the references on the documents and judge all of them."""
    terms = vocabulary(docs, limits, **{k: v for k, v in columns.items() if k != "id_column"})
    counts = written(measured(docs, terms, **columns), "quality-counts")
    return verdicts(counts, summed(counts, terms, limits), limits)
