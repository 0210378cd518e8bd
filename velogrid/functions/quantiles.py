"""Exact percentiles without gathering the values in one task: sketched brackets, then ranks inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sketch errs by one in so many ranks at most, and a bracket reaches so many times further.
ACCURACY, MARGIN = 20_000, 3


def brackets(columns: dict[str, Column], points: dict[str, float]) -> Column:
    """An aggregate: per column its number of values, and below and above every wanted percentile a value of the sketch.

    It can stand in one aggregate with other figures of the same rows.
    """
    shift = MARGIN / ACCURACY
    shares = [q for p in points.values() for q in (max(0.0, p - shift), min(1.0, p + shift))]

    def bracket(x: Column) -> Column:
        x = x.cast("double")
        return F.struct(F.count(x).alias("rows"), F.percentile_approx(x, shares, ACCURACY).alias("cuts"))

    return F.struct(*[bracket(x).alias(c) for c, x in columns.items()])


def _ends(points: dict[str, float]) -> list[tuple[str, str]]:
    """SQL for the lower and upper end of each bracket of ``cuts``; open where the bracket reaches the least or largest value."""
    shift, out = MARGIN / ACCURACY, []
    for i, p in enumerate(points.values()):
        low = "double('-infinity')" if p - shift <= 0 else f"get(cuts, {2 * i})"
        high = "double('nan')" if p + shift >= 1 else f"get(cuts, {2 * i + 1})"  # nothing is above nan
        out.append((low, high))
    return out


def within_brackets(df: DataFrame, columns: dict[str, Column], points: dict[str, float], first: DataFrame, cuts: str) -> DataFrame:
    """One row with a struct per column: a linearly interpolated percentile per name in ``points``, and ``first`` as ``_first``.

    ``first`` is one row of one struct, whose field ``cuts`` is the ``brackets`` of the same rows; it joins the plan as a scalar subquery. One
    pass counts what lies between brackets and the equal values inside them; only the latter are ranked, each bracket for itself, so
    a task ranks about one value in 3000. The sketch's error is bounded, so a wanted rank lies in its bracket; should one ever not,
    the query fails rather than return another value.
    """
    known = first.scalar()
    one = [F.struct(F.lit(c).alias("c"), x.cast("double").alias("x"), F.col(f"_first.{cuts}.{c}.cuts").alias("cuts")) for c, x in columns.items()]
    rows = df.withColumn("_first", known).select(F.inline(F.array(*one))).where("x is not null")
    ends = _ends(points)
    # Grows with x; a value is inside a bracket where it has passed more lower than upper ends.
    lower = " + ".join(f"if(x >= {low}, 1, 0)" for low, _ in ends)
    upper = " + ".join(f"if(x > {high}, 1, 0)" for _, high in ends)
    placed = rows.selectExpr("c", "x", f"{lower} as lower", f"{upper} as upper")
    counts = placed.selectExpr("c", "lower + upper as region", "if(lower > upper, x, null) as x", "lower > upper as inside")
    # ``inside`` is an aggregate, and both readers need it, so that they share the shuffled counts.
    counts = counts.groupBy("c", "region", "x").agg(F.count("*").alias("n"), F.max("inside").alias("inside"))
    sizes = counts.groupBy("c", "region").agg(F.sum("n").alias("size"), F.max("inside").alias("held"))
    before = sizes.selectExpr("c", "region", "held", "sum(size) over (partition by c order by region) - size as before")
    # Two rows at most per wanted percentile and column, and one more.
    ranked = counts.where("inside").join(F.broadcast(before), ["c", "region"]).where("held")
    ranked = ranked.selectExpr("c", "x", "n", "before + sum(n) over (partition by c, region order by x) as stop").withColumn("_first", known)

    def value_at(column: str, rank: str) -> str:
        return f"max(case when c = '{column}' and stop - n <= {rank} and {rank} < stop then x end)"

    out = []
    for c in columns:
        found = []
        for name, p in points.items():
            place = f"((_first.{cuts}.`{c}`.rows - 1) * {float(p)}D)"
            low, high = value_at(c, f"floor{place}"), value_at(c, f"ceil{place}")
            over = f"max(case when c = '{c}' then {place} - floor{place} end)"
            value = F.expr(f"{low} + ({high} - {low}) * {over}")
            outside = F.expr(f"count_if(c = '{c}') > 0") & value.isNull()
            found.append(F.when(outside, F.raise_error(F.lit(f"a percentile of {c} lies outside its bracket")).cast("double")).otherwise(value).alias(name))
        out.append(F.struct(*found).alias(c))
    return ranked.agg(*out).withColumn("_first", known)


def exact_percentiles_of(df: DataFrame, columns: list[str], points: dict[str, float]) -> DataFrame:
    """One row with a struct per column: a linearly interpolated percentile per name in ``points``; null for a column without values."""
    named = {c: F.col(f"`{c}`") for c in columns}
    first = df.agg(F.struct(brackets(named, points).alias("cuts")))
    return within_brackets(df, named, points, first, "cuts").select(*[F.col(f"`{c}`") for c in columns])


def exact_percentiles(df: DataFrame, column: str, points: dict[str, float]) -> DataFrame:
    """One row with a linearly interpolated percentile of ``column`` per name in ``points``."""
    return exact_percentiles_of(df, [column], points).select(F.col(f"`{column}`.*"))
