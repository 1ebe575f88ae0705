"""Exact interpolated quantiles of whole tables without a sort of the table.

``percentile()`` and ``median()`` merge every distinct value of a column in
one task.  Here wanted ranks are narrowed down instead.  A gap is an open range
of values that holds wanted ranks, with the exact number of values in it and
below it.  While a gap holds more than ``SMALL`` values, approximate quantiles
of its values give ends close to both sides of each wanted rank, and one
counting pass, combined map-side to a few rows, tells exactly how many values
lie below, at and between the ends.  A rank at an end is known; any other is in
a gap with a few ten-thousandths of the values.  Ends are values of the column
themselves, so every pass shrinks every gap, copies of one value never stay in
one, and a rank that the approximation missed is in a neighbouring gap.  Gaps
of at most ``SMALL`` values are ranked, each in a task.

So the state on the driver is a few numbers per wanted rank, and no task orders
more than ``SMALL`` values, whatever the number of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesweft.session import written

ACCURACY = 10_000
MARGIN = 2 / ACCURACY
SMALL = 1 << 18
MAX_PASSES = 64


@dataclass(frozen=True)
class Gap:
    """The values of a field above ``low`` and below ``high`` (None: no end), with the ranks wanted among them."""

    field: str
    low: float | None
    high: float | None
    before: int
    count: int
    ranks: tuple[int, ...]

    def holds(self) -> Column:
        value, held = F.col("value"), F.col("field") == self.field
        if self.low is not None:
            held = held & (value > self.low)
        return held if self.high is None else held & (value < self.high)


def _per_field(made: dict[str, Column]) -> Column:
    out = F.lit(0)
    for field, column in made.items():
        out = F.when(F.col("field") == field, column).otherwise(out)
    return out


def _cell(ends: list[float]) -> Column:
    """Twice the number of ends below a value, and one more at an end."""
    value = F.col("value")
    return sum(((value > e).cast("int") + (value >= e).cast("int") for e in ends), F.lit(0))


def _near(long: DataFrame, gaps: list[Gap]) -> dict[str, set[float]]:
    """Values of the gaps close to both sides of the wanted ranks, by field; all from one pass."""
    marks = []
    for number, gap in enumerate(gaps):
        at = [(rank - gap.before) / max(1, gap.count - 1) + side * MARGIN for rank in gap.ranks for side in (-1, 1)]
        inside = F.when(gap.holds(), F.col("value"))
        marks.append(F.percentile_approx(inside, F.array(*[F.lit(min(1.0, max(0.0, p))) for p in at]), ACCURACY).alias(str(number)))
    out: dict[str, set[float]] = {}
    for gap, found in zip(gaps, long.agg(*marks).first()):
        out.setdefault(gap.field, set()).update(found)
    return out


def _located(counts: dict[int, int], field: str, ends: list[float], ranks: list[int], known: dict[tuple[str, int], float]) -> list[Gap]:
    """The gaps between the ends that hold wanted ranks; ranks at an end become known."""
    gaps, before = [], 0
    for cell in range(2 * len(ends) + 1):
        n = counts.get(cell, 0)
        here = tuple(r for r in ranks if before <= r < before + n)
        if here and cell % 2:
            known.update({(field, r): ends[cell // 2] for r in here})
        elif here:
            low, high = (ends[cell // 2 - 1] if cell else None), (ends[cell // 2] if cell // 2 < len(ends) else None)
            gaps.append(Gap(field, low, high, before, n, here))
        before += n
    return gaps


def _narrowed(long: DataFrame, gaps: list[Gap], known: dict[tuple[str, int], float]) -> list[Gap]:
    """One pass of narrowing: the small gaps stay, the large ones are cut at new ends."""
    large = [g for g in gaps if g.count > SMALL]
    ends = {}
    for field, found in _near(long, large).items():
        bounds = {e for g in large if g.field == field for e in (g.low, g.high) if e is not None}
        ends[field] = sorted(bounds | found)
    counted = long.where(F.col("field").isin(list(ends))).groupBy("field", _per_field({f: _cell(e) for f, e in ends.items()}).alias("cell"))
    counts: dict[str, dict[int, int]] = {f: {} for f in ends}
    for r in counted.agg(F.count("*").alias("n")).collect():
        counts[r["field"]][r["cell"]] = r["n"]
    out = [g for g in gaps if g.count <= SMALL]
    for field, marks in ends.items():
        wanted = sorted({r for g in large if g.field == field for r in g.ranks})
        out += _located(counts[field], field, marks, wanted, known)
    return out


def _ranked(long: DataFrame, gaps: list[Gap]) -> dict[tuple[str, int], float]:
    """The values at the wanted ranks of small gaps; every gap is ordered by a task of its own."""
    number, shift, wanted = F.lit(None).cast("int"), F.lit(0), F.array().cast("array<bigint>")
    for n, gap in enumerate(gaps):
        number = F.when(gap.holds(), n).otherwise(number)
        shift = F.when(F.col("gap") == n, F.lit(gap.before)).otherwise(shift)
        wanted = F.when(F.col("gap") == n, F.array(*[F.lit(r).cast("long") for r in gap.ranks])).otherwise(wanted)
    inside = long.select("field", "value", number.alias("gap")).where("gap IS NOT NULL").groupBy("gap", "field", "value").agg(F.count("*").alias("n"))
    upto = inside.withColumn("upto", shift + F.sum("n").over(Window.partitionBy("gap").orderBy("value")))
    hits = upto.withColumn("rank", F.explode(wanted)).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    return {(r["field"], r["rank"]): r["value"] for r in hits.select("field", "rank", "value").collect()}


def rank_values(long: DataFrame, wanted: dict[str, list[int]], totals: dict[str, int]) -> dict[tuple[str, int], float]:
    """The value at each wanted zero-based rank of a (field, value) table without nulls and NaN."""
    known: dict[tuple[str, int], float] = {}
    gaps = [Gap(f, None, None, 0, totals[f], tuple(ranks)) for f, ranks in wanted.items() if ranks]
    for _ in range(MAX_PASSES):
        if all(g.count <= SMALL for g in gaps):
            return known | (_ranked(long, gaps) if gaps else {})
        gaps = _narrowed(long, gaps, known)
    raise RuntimeError("ranks did not settle")


def exact_quantiles(df: DataFrame, fields: list[str], probabilities: list[float], stored: bool = False) -> DataFrame:
    """Rows ``(field, probability, value)``, linear interpolation, nulls skipped.

    Gives the same values as ``percentile(field, probability)``; NaN is above
    all numbers.  The fields are written once, narrow, so what they come from
    is computed once, unless the frame is ``stored`` already.
    """
    spark = df.sparkSession
    values = df.select(*[F.col(f).cast("double").alias(f) for f in fields])
    values = values if stored else written(values, "quantile-values")
    long = values.unpivot([], fields, "field", "value").where("value IS NOT NULL")
    sizes = {r["field"]: (r["n"], r["numbers"]) for r in long.groupBy("field").agg(
        F.count("*").alias("n"), F.count_if(~F.isnan("value")).alias("numbers")
    ).collect()}
    places = [(f, p, p * (n - 1)) for f, (n, _) in sizes.items() for p in probabilities]
    ranks = {(f, int(r)) for f, _, at in places for r in (math.floor(at), math.ceil(at))}
    wanted = {f: sorted(r for g, r in ranks if g == f and r < numbers) for f, (_, numbers) in sizes.items()}
    known = rank_values(long.where(~F.isnan("value")), wanted, {f: numbers for f, (_, numbers) in sizes.items()})
    rows = []
    for f, p, at in places:
        low, high = (known.get((f, int(r)), math.nan) for r in (math.floor(at), math.ceil(at)))
        fraction = at - math.floor(at)
        rows.append((f, float(p), low if low == high else (1 - fraction) * low + fraction * high))
    return spark.createDataFrame(rows, "field string, probability double, value double")


def with_quantiles(
    df: DataFrame, source: DataFrame, fields: list[str], probabilities: dict[str, float],
    name: str = "_q", stored: bool = False,
) -> DataFrame:
    """``df`` with all quantiles of ``source`` as one struct column of literals.

    Struct fields are ``<field>_<name>``; null for a field without values.
    """
    found = {(r["field"], r["probability"]): r["value"] for r in exact_quantiles(source, fields, list(probabilities.values()), stored).collect()}
    marks = [F.lit(found.get((f, float(p)))).cast("double").alias(f"{f}_{label}") for f in fields for label, p in probabilities.items()]
    return df.withColumn(name, F.struct(*marks))
