"""Exact quantiles and ranks of columns of any size: no group is sorted in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.operators.joins import sized
from flowlab.sources.shared import stage

#: Accuracy of the approximate quantiles that bracket a rank (their error is at most one row in so many), and parts of a bracket.
ACCURACY, PARTS = 10_000, 4096


def exact_quantiles(df: DataFrame, by: list[str], value: str, shares: list[float]) -> DataFrame:
    """(by..., i, quantile): for each group and the i-th share (from 0) the quantile of the non-null values, interpolated
    between neighbours as `percentile` does; groups without values have no rows. NaN counts as the largest value.

    Approximate quantiles a little below and above a share bracket its rank for sure. Rows below a bracket are counted, rows above it
    dropped, and only distinct values inside it are kept, with their counts. Those are counted in PARTS parts of the bracket, and only the
    parts that hold the rank are ordered: of n rows about n / (ACCURACY * PARTS) meet in one task."""
    keys = [F.col(f"`{c}`").alias(f"_k{j}") for j, c in enumerate(by)]
    names = [f"_k{j}" for j in range(len(by))]
    rows = df.select(*keys, F.col(f"`{value}`").cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    margin = 3 / ACCURACY
    ends = [(max(0.0, q - margin), min(1.0, q + margin)) for q in shares]
    sketch = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", [e for pair in ends for e in pair], ACCURACY).alias("_p"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    few = F.col("_n") <= 10 * ACCURACY  # a bracket must be several rows wide
    brackets = F.array(*[
        F.struct(F.lit(i).alias("i"), F.when(few | F.lit(a == 0), F.col("_lo")).otherwise(F.col("_p")[2 * i]).alias("lo"), F.when(few | F.lit(z == 1), F.col("_hi")).otherwise(F.col("_p")[2 * i + 1]).alias("hi"))
        for i, (a, z) in enumerate(ends)
    ])
    # a row for each group: few are sent to every task and no row moves; many are small groups, and rows meet theirs
    groups = sized(stage(sketch.select(*[F.col(n).alias(f"g{n}") for n in names], "_n", brackets.alias("_b")), "brackets"))
    same = [F.col(n).eqNullSafe(F.col(f"g{n}")) for n in names]
    met = rows.join(groups, same, "inner") if names else rows.join(F.broadcast(groups), how="cross")  # one row
    inside = F.filter(F.col("_b"), lambda b: F.col("_v") <= b["hi"])
    kept = F.transform(inside, lambda b: F.struct(b["i"].alias("i"), b["lo"].alias("lo"), b["hi"].alias("hi"), F.when(F.col("_v") >= b["lo"], F.col("_v")).alias("v")))
    values = met.select(*names, "_n", F.explode(kept).alias("e")).groupBy(*names, "_n", F.col("e.i").alias("i"), F.col("e.lo").alias("lo"), F.col("e.hi").alias("hi"), F.col("e.v").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    width = F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    part = F.when(F.col("v").isNull(), -1).otherwise(F.coalesce(F.least(F.floor((F.col("v") - F.col("lo")) / width * PARTS), F.lit(PARTS)), F.lit(0))).cast("int")
    values = values.withColumn("part", part)
    group = [*names, "i"]
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most PARTS + 2 rows
    sums = values.groupBy(*group, "part", "_n").agg(F.sum("c").alias("m")).withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
    share = F.element_at(F.array(*[F.lit(float(q)) for q in shares]), F.col("i") + 1)
    place = share * (F.col("_n") - 1)
    low, high = F.floor("place"), F.ceil("place")
    holds = lambda r: (F.col("before") <= r) & (r < F.col("before") + F.col("m"))
    hit = sums.withColumn("place", place).filter(holds(low) | holds(high)).select(*[F.col(n).alias(f"h{n}") for n in names], F.col("i").alias("h_i"), F.col("part").alias("h_part"), "before", "place")
    on = [F.col(n).eqNullSafe(F.col(f"h{n}")) for n in names] + [F.col("i") == F.col("h_i"), F.col("part") == F.col("h_part")]
    upto = Window.partitionBy(*group, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = values.join(hit, on).withColumn("upto", F.col("before") + F.sum("c").over(upto))
    found = lambda r: F.min(F.when(F.col("upto") > r, F.col("v")))
    ends_of = ordered.groupBy(*group, "place").agg(found(low).alias("a"), found(high).alias("b"), F.min("part").alias("part"))
    ends_of = ends_of.withColumn("a", F.when(F.col("part") < 0, F.raise_error(F.lit("a rank lies below its bracket"))).otherwise(F.col("a")))
    between = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((high - F.col("place")) * F.col("a") + (F.col("place") - low) * F.col("b"))
    return ends_of.select(*[F.col(n).alias(c) for n, c in zip(names, by, strict=True)], "i", between.alias("quantile"))


def pivoted(quantiles: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """A row for each group with its quantiles under the given names, in the order of the shares."""
    return quantiles.groupBy(*by).agg(*[F.max(F.when(F.col("i") == i, F.col("quantile"))).alias(n) for i, n in enumerate(names)])


def range_parts(df: DataFrame, by: list[str], value: str, out: str, parts: int = 32) -> DataFrame:
    """df with `out`: the part, of about `parts` of equal size in its group, that holds the value; parts are in order of values."""
    cuts = df.groupBy(*by).agg(F.array_distinct(F.percentile_approx(value, [i / parts for i in range(1, parts)], ACCURACY)).alias("_cuts")).select(*[F.col(c).alias(f"_c{j}") for j, c in enumerate(by)], "_cuts")
    met = df.join(sized(stage(cuts, "cuts")), [F.col(c).eqNullSafe(F.col(f"_c{j}")) for j, c in enumerate(by)])
    return met.withColumn(out, F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts", *[f"_c{j}" for j in range(len(by))])
