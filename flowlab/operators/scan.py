"""Running values over ordered rows as a parallel prefix scan of a monoid: no key is one task, however many rows it has.

Rows are dealt in ranges of (key, order), so a long key is spread over many parts. Each part is cut into blocks of FAN rows. The sweep
up folds blocks, then the blocks of a part, then the parts of a key; the sweep down hands every block what lies before it. Only one
value a block goes up and comes down, and every fold is over a short array.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.sources.shared import stage, unstage

#: Rows in a block, and in a part (which has at most ROWS / FAN blocks).
FAN, ROWS = 64, 50_000


@dataclass(frozen=True)
class Monoid:
    """An associative `combine` of struct columns with its `identity`; `lift` makes one of a row's columns."""

    lift: Column
    combine: Callable[[Column, Column], Column]
    identity: Column


def affine(value: str, alpha: float) -> Monoid:
    """Exponential means: a row maps the mean m to (1 - alpha) * m + alpha * value; maps are composed. `first` is the mean that the run
    starts from, its own first value. Null and NaN values leave the mean as it is. The mean is slope * first + shift (`mean_of`)."""
    x = F.col(value).cast("double")
    some = x.isNotNull() & ~F.isnan(x)
    none = F.lit(None).cast("double")

    def combine(a: Column, b: Column) -> Column:
        return F.struct(F.coalesce(a["first"], b["first"]).alias("first"), (a["slope"] * b["slope"]).alias("slope"), (b["slope"] * a["shift"] + b["shift"]).alias("shift"))

    lift = F.struct(F.when(some, x).alias("first"), F.when(some, 1 - alpha).otherwise(1.0).alias("slope"), F.when(some, alpha * x).otherwise(0.0).alias("shift"))
    return Monoid(lift, combine, F.struct(none.alias("first"), F.lit(1.0).alias("slope"), F.lit(0.0).alias("shift")))


def mean_of(run: Column) -> Column:
    return run["slope"] * run["first"] + run["shift"]


def run_lengths(holds: Column) -> Monoid:
    """How many rows up to here hold without a break (`run`); `whole` says that all did. A null condition does not hold."""
    yes = F.coalesce(holds, F.lit(False))

    def combine(a: Column, b: Column) -> Column:
        return F.struct((b["run"] + F.when(b["whole"], a["run"]).otherwise(0)).alias("run"), (a["whole"] & b["whole"]).alias("whole"))

    return Monoid(F.struct(yes.cast("bigint").alias("run"), yes.alias("whole")), combine, F.struct(F.lit(0).cast("bigint").alias("run"), F.lit(True).alias("whole")))


def _prefixes(items: Column, m: Monoid) -> Column:
    """[identity, x1, x1 x2, ...], one more than items."""
    return F.aggregate(items, F.array(m.identity), lambda acc, x: F.concat(acc, F.array(m.combine(F.element_at(acc, -1), x))))


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def prefix_scan(df: DataFrame, keys: list[str], order: list[str], m: Monoid, out: str, rows: int | None = None) -> DataFrame:
    """df with `out`: the combination of all rows of the same keys up to this one, in the order of `order` (nulls first). Null keys are one key.

    Rows that are equal in order come in no particular one, so order should tell them apart where that matters. An empty table stays empty.
    No column of df may be named like one of the scan (they begin with __scan)."""
    rows = rows or ROWS
    n_parts = max(1, -(-df.count() // rows))
    placed = df.withColumn("__scan_x", m.lift).repartitionByRange(n_parts, *keys, *order).withColumn("__scan_part", F.spark_partition_id())
    placed = stage(placed, "scan-rows")  # from here on a row's part is a fact
    by = [*keys, "__scan_part"]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    kept = F.struct(F.col("__scan_place"), F.col("__scan_x"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    blocks = placed.withColumn("__scan_place", place).withColumn("__scan_block", (F.col("__scan_place") / FAN).cast("int")).groupBy(*by, "__scan_block").agg(F.array_sort(F.collect_list(kept), lambda a, b: a["__scan_place"] - b["__scan_place"]).alias("rows"))
    blocks = blocks.withColumn("runs", _prefixes(F.transform("rows", lambda r: r["__scan_x"]), m))
    blocks = stage(blocks.withColumn("total", F.element_at("runs", -1)), "scan-blocks")
    ordered = lambda place, value: F.transform(F.array_sort(F.collect_list(F.struct(place, value)), lambda a, b: a[place] - b[place]), lambda s: s[value])
    parts = blocks.groupBy(*by).agg(_prefixes(ordered("__scan_block", "total"), m).alias("befores")).withColumn("total", F.element_at("befores", -1))
    parts = stage(parts, "scan-parts")
    unstage(placed)
    # a value for each part that a key reaches
    whole = parts.groupBy(*keys).agg(F.sort_array(F.collect_list("__scan_part")).alias("numbers"), _prefixes(ordered("__scan_part", "total"), m).alias("befores"))
    down = whole.select(*[F.col(k).alias(f"__scan_{i}") for i, k in enumerate(keys)], F.explode(F.arrays_zip("numbers", F.expr("slice(befores, 1, size(numbers))").alias("before"))).alias("p"))
    down = down.select(*[f"__scan_{i}" for i in range(len(keys))], F.col("p.numbers").alias("__scan_p"), F.col("p.before").alias("__scan_before"))
    names = [f"__scan_{i}" for i in range(len(keys))]
    each = parts.select(*by, "befores").join(down, _same(by, [*names, "__scan_p"])).select(*[F.col(c).alias(f"__scan_of_{i}") for i, c in enumerate(by)], "befores", "__scan_before")
    met = blocks.join(each, _same(by, [f"__scan_of_{i}" for i in range(len(by))]))
    before = m.combine(F.col("__scan_before"), F.element_at("befores", F.col("__scan_block") + 1))
    zipped = F.arrays_zip(F.transform("rows", lambda r: r["row"]).alias("row"), F.slice("runs", 2, F.size("rows")).alias("run"))
    each_row = met.withColumn("__scan_all", before).select("__scan_all", F.explode(zipped).alias("z"))
    return each_row.select("z.row.*", m.combine(F.col("__scan_all"), F.col("z.run")).alias(out))


def run_exactly(df: DataFrame, keys: list[str], order: list[str], value: str, alpha: float, out: str, rows: int | None = None) -> DataFrame:
    """df with `out`: the exponential mean of its keys up to each row, bit for bit as one loop m + alpha * (x - m) over all rows of a key gives
    it, which a composition of maps (`affine`) does not. Null and NaN values leave the mean as it is.

    Maps are composed only for the guess that each part starts from. Parts run the loop; then each one starts from what the one before
    ended with, until all ends are the starts that follow. A wrong last bit is forgotten within some multiples of 1 / alpha rows, so two or three rounds
    are enough where a part has more rows than that; otherwise there are more, at most one for each part of a key."""
    rows = rows or ROWS
    n_parts = max(1, -(-df.count() // rows))
    x = F.col(value).cast("double")
    placed = df.withColumn("__scan_x", F.when(~F.isnan(x), x)).repartitionByRange(n_parts, *keys, *order).withColumn("__scan_part", F.spark_partition_id())
    placed = stage(placed, "scan-rows")
    by, none = [*keys, "__scan_part"], F.lit(None).cast("double")
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    kept = F.struct(F.col("__scan_place"), F.col("__scan_x"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    blocks = placed.withColumn("__scan_place", place).withColumn("__scan_block", (F.col("__scan_place") / FAN).cast("int")).groupBy(*by, "__scan_block").agg(F.array_sort(F.collect_list(kept), lambda a, b: a["__scan_place"] - b["__scan_place"]).alias("rows"))
    blocks = stage(blocks, "scan-blocks")
    unstage(placed)
    step = lambda m, x: F.coalesce(m + alpha * (x - m), m, x)
    loop = lambda m, values: F.aggregate(values, m, step)
    in_order = F.array_sort(F.collect_list(F.struct("__scan_block", F.transform("rows", lambda r: r["__scan_x"]).alias("x"))), lambda a, b: a["__scan_block"] - b["__scan_block"])
    parts = stage(blocks.groupBy(*by).agg(F.transform(in_order, lambda b: b["x"]).alias("values")), "scan-parts")
    before = Window.partitionBy(*keys).orderBy("__scan_part")  # a value for each part that a key reaches
    m = affine("x", alpha)
    lifted = lambda v: F.struct(v.alias("first"), F.when(v.isNotNull(), 1 - alpha).otherwise(1.0).alias("slope"), F.coalesce(alpha * v, F.lit(0.0)).alias("shift"))
    total = F.aggregate(F.flatten("values"), m.identity, lambda acc, v: m.combine(acc, lifted(v)))
    totals = F.collect_list("total").over(before.rowsBetween(Window.unboundedPreceding, -1))
    guess = mean_of(F.aggregate(totals, m.identity, m.combine))
    starts = stage(parts.select(*by, total.alias("total")).select(*by, guess.alias("start")), "scan-starts")
    while True:
        met = parts.join(starts.select(*[F.col(c).alias(f"__scan_of_{i}") for i, c in enumerate(by)], "start"), _same(by, [f"__scan_of_{i}" for i in range(len(by))]))
        ends = met.select(*by, "start", F.aggregate("values", F.col("start"), loop).alias("end"))
        after = stage(ends.select(*by, F.col("start").alias("was"), F.lag("end").over(before).alias("start")), "scan-starts")
        unstage(starts)
        starts = after
        if starts.filter(~F.col("was").eqNullSafe(F.col("start"))).isEmpty():
            break
    begins = F.aggregate("values", F.array("start"), lambda acc, b: F.concat(acc, F.array(loop(F.element_at(acc, -1), b))))
    names = [f"__scan_of_{i}" for i in range(len(by))]
    starts = starts.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], "start")
    each = parts.join(starts, _same(by, names)).select(*names, begins.alias("begins"))
    met = blocks.join(each, _same(by, names)).select("rows", F.element_at("begins", F.col("__scan_block") + 1).alias("begin"))
    runs = F.aggregate("rows", F.array("begin"), lambda acc, r: F.concat(acc, F.array(step(F.element_at(acc, -1), r["__scan_x"]))))
    zipped = F.arrays_zip(F.transform("rows", lambda r: r["row"]).alias("row"), F.slice(runs, 2, F.size("rows")).alias("run"))
    return met.select(F.explode(zipped).alias("z")).select("z.row.*", F.col("z.run").alias(out))


def fold(df: DataFrame, keys: list[str], order: list[str], m: Monoid, out: str, rows: int | None = None) -> DataFrame:
    """(keys, out): the combination of all rows of each key, in order; one row for each key. What goes up is one value a block."""
    rows = rows or ROWS
    n_parts = max(1, -(-df.count() // rows))
    placed = df.select(*keys, *order, m.lift.alias("__scan_x")).repartitionByRange(n_parts, *keys, *order).withColumn("__scan_part", F.spark_partition_id())
    placed = stage(placed, "scan-rows")
    by = [*keys, "__scan_part"]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    level = placed.withColumn("__scan_place", place).select(*by, F.col("__scan_place"), F.col("__scan_x"))
    folded = lambda values: F.aggregate(values, m.identity, lambda acc, x: m.combine(acc, x))
    in_order = lambda at: F.transform(F.array_sort(F.collect_list(F.struct(at, "__scan_x")), lambda a, b: a[at] - b[at]), lambda s: s["__scan_x"])
    level = level.groupBy(*by, (F.col("__scan_place") / FAN).cast("int").alias("__scan_block")).agg(folded(in_order("__scan_place")).alias("__scan_x"))
    level = level.groupBy(*by).agg(folded(in_order("__scan_block")).alias("__scan_x"))
    return level.groupBy(*keys).agg(folded(in_order("__scan_part")).alias(out))
