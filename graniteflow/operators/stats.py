"""Counts, coverage and quality gates: one aggregation pass per question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """part / whole, with a defined value where there is nothing to divide by."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(empty))


def coverage(df: DataFrame, by: list[str], **conditions: Column) -> DataFrame:
    """Rows in all and rows satisfying each condition with their share, per group; null conditions count as false."""
    sums = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()]
    out = df.groupBy(*by).agg(F.count("*").alias("total"), *sums)
    return out.select(*by, "total", *conditions, *(F.round(ratio(F.col(n), F.col("total")), 6).alias(f"{n}_rate") for n in conditions))


def gate(total: Column, ok: Column, threshold: float, empty_passes: bool) -> Column:
    """Whether a run passes: its share of successes reaches the threshold; without rows it passes or fails as told."""
    return F.when(total == 0, F.lit(empty_passes)).otherwise(ok / total >= threshold)


def exact_quantiles(df: DataFrame, by: list[str], column: str, accuracy: int = 10_000, **points: float) -> DataFrame:
    """(by ..., n, one column a point): exact interpolated quantiles of the non-null values of each group, and their number.

    No task holds the values of a group. A sketch of bounded size gives for every point two values that its rank lies
    between; one pass counts what is below them and the distinct values between, about 4 / ``accuracy`` of the group, and the
    next ones outside; the two values next to the rank are picked from these. Groups without values are left out.
    """
    rows = df.where(F.col(column).isNotNull()).select(*by, F.col(column).alias("v"))
    shares = list(points.values())
    low = F.array(*(F.percentile_approx("v", max(0.0, p - 2 / accuracy), accuracy) for p in shares))
    high = F.array(*(F.percentile_approx("v", min(1.0, p + 2 / accuracy), accuracy) for p in shares))
    marks = rows.groupBy(*by).agg(F.count("*").alias("n"), low.alias("low"), high.alias("high"))
    met = rows.join(marks, by)  # by a broadcast where there are few groups; a hot one is split otherwise
    each = met.select(*by, "n", "v", F.posexplode(F.arrays_zip("low", "high")).alias("point", "m"))
    place = F.when(F.col("v") < F.col("m.low"), -1).when(F.col("v") > F.col("m.high"), 1).otherwise(0)
    # below: their number and the largest; above: the smallest; between: every distinct value with its number
    grouped = each.withColumn("place", place).groupBy(*by, "n", "point", "place", F.when(F.col("place") == 0, F.col("v")).alias("value"))
    parts = grouped.agg(F.count("*").alias("k"), F.max("v").alias("most"), F.min("v").alias("least"))
    value = F.when(F.col("place") < 0, F.col("most")).when(F.col("place") > 0, F.col("least")).otherwise(F.col("value"))
    w = Window.partitionBy(*by, "point").orderBy("place", "value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = parts.withColumn("value", value).withColumn("until", F.sum("k").over(w))
    share = F.element_at(F.array(*(F.lit(float(p)) for p in shares)), F.col("point") + 1)
    rank = share * (F.col("n") - 1)
    holds = lambda r: (r >= F.col("until") - F.col("k")) & (r < F.col("until"))
    pick = lambda r: F.max(F.when(holds(r), F.col("value"))).cast("double")
    two = ranked.groupBy(*by, "n", "point").agg(pick(F.floor(rank)).alias("a"), pick(F.ceil(rank)).alias("b"))
    got = two.withColumn("q", F.col("a") + (F.col("b") - F.col("a")) * (rank - F.floor(rank)))
    return got.groupBy(*by, "n").agg(*(F.max(F.when(F.col("point") == i, F.col("q"))).alias(name) for i, name in enumerate(points)))
