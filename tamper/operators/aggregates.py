"""Grouped report operators (histograms, counts, shares, top-k, box stats).

Group keys of the reports are low-cardinality, so every aggregate here is a
partial (map-side) aggregation followed by a tiny shuffle. Totals that a share
needs are scalar subqueries, never a window over the whole input and never a
cross join. NULL group keys are dropped and all-NULL groups sum to 0, as the
dashboards' frame operations do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c) -> Column:
    """Exact decimal sum reported as DOUBLE; an empty or all-NULL group gives 0."""
    return F.coalesce(F.sum(_c(c)).cast("double"), F.lit(0.0))


def exact_mean(c) -> Column:
    """Mean as exact sum / count, in DOUBLE; NULLs skipped; NULL when empty."""
    return F.try_divide(F.sum(_c(c)).cast("double"), F.count(_c(c)).cast("double"))


def count_by(df: DataFrame, key: str, out: str = "n_orders") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))


def sum_by(df: DataFrame, key, value: str, out: str) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond).groupBy(*keys).agg(money_sum(value).alias(out))


def with_share(counts: DataFrame, value: str, out: str = "share_pct") -> DataFrame:
    """share = value x 100 / total. The total is a scalar subquery over the
    (already small) grouped frame."""
    total = counts.select(F.sum(F.col(value).cast("double"))).scalar()
    return counts.withColumn(out, F.try_divide(F.col(value).cast("double") * 100.0, total))


def share_by(df: DataFrame, key: str, out: str = "n_orders") -> DataFrame:
    return with_share(count_by(df, key, out), out)


def top_k(df: DataFrame, key: str, value: str, n: int = 10) -> DataFrame:
    """The ``n`` largest groups, ties broken by key ascending
    (planned as TakeOrderedAndProject: a per-partition top-n, then a merge)."""
    return df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(n)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max of the non-NULL values; the last
    bin is closed. When min = max the range is ``[v - 0.5, v + 0.5]``. Every
    bin is returned, empty ones with 0.

    Bin assignment is the usual equal-width histogram rule, bit for bit:
    ``floor((v - lo) / (hi - lo) * bins)`` (the maximum folded into the last
    bin), then moved down one bin if ``v`` is below that bin's lower edge and
    up one if it is at or above the next edge, with edges ``i * step + lo`` and
    the last edge exactly ``hi``. Float rounding at edges therefore resolves
    the same way as in array libraries.

    The rows are read once and nothing runs while the frame is built: they are first
    aggregated to value -> count, and both the bounds (a scalar subquery) and the bins
    read that aggregate, whose exchange Spark reuses."""
    values = (df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
              .groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    # n takes part, so that both readers of the aggregate need the same columns of it
    range_of = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("n")).where("n > 0")
    same = F.col("lo") == F.col("hi")
    range_of = range_of.select(F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("first"),
                               F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("last"))
    bounds = range_of.select(F.struct("first", "last", ((F.col("last") - F.col("first")) / float(bins)).alias("step")
                                      ).alias("b")).scalar()
    first, last, step, v = F.col("b.first"), F.col("b.last"), F.col("b.step"), F.col("v")

    def edge(i):
        return F.when(i >= bins, last).otherwise(i.cast("double") * step + first)

    raw = F.floor((v - first) / (last - first) * float(bins))
    i0, i1 = F.col("i0"), F.col("i1")
    binned = (values.withColumn("b", bounds)
              .withColumn("i0", F.when(raw >= bins, F.lit(bins - 1).cast("long")).otherwise(raw))
              .withColumn("i1", F.when(v < edge(i0), i0 - 1).otherwise(i0))
              .withColumn("bin", F.when((v >= edge(i1 + 1)) & (i1 != bins - 1), i1 + 1).otherwise(i1)))
    counts = binned.groupBy(F.col("bin").alias("filled")).agg(F.sum("n").alias("n"))
    # ``bins`` rows by construction: a bounded broadcast. Null-safe, because a plain
    # equality would push "is not NULL" of the whole bin expression down to the values.
    grid = F.broadcast(df.sparkSession.range(bins).withColumnRenamed("id", "bin"))
    return (grid.join(counts, F.col("bin").eqNullSafe(F.col("filled")), "left").withColumn("b", bounds)
            .select(F.col("bin"),
                    edge(F.col("bin")).alias("bin_start"),
                    edge(F.col("bin") + 1).alias("bin_end"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_rows")))


def running_weights(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(pid, keys, v, c, below, n): every different non-NULL value of each group with its
    count, the rows of the group below it, and the rows of the group.

    Values are counted map-side, dealt to ranges of (keys, value) and stored; a task sums
    its own range, and a group that spans several ranges gets their totals, one row for
    each range and group. No task holds more than a range of a group's values."""
    from tamper.plans.layers import written

    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("v"))
              .agg(F.count(F.lit(1)).alias("c")))
    ranged = written(counts.repartitionByRange(*keys, "v").withColumn("pid", F.spark_partition_id()),
                     "value_counts")
    local = Window.partitionBy("pid", *keys)
    rows = ranged.withColumn("below", F.sum("c").over(local.orderBy("v")) - F.col("c"))
    parts = ranged.groupBy("pid", *keys).agg(F.sum("c").alias("part"))
    group = Window.partitionBy(*keys)  # at most one row for each range
    before = group.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("pid").alias("__pid"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                         F.coalesce(F.sum("part").over(before), F.lit(0)).alias("__before"),
                         F.sum("part").over(group).alias("n"))
    same = [F.col("pid") == F.col("__pid")] + [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return rows.join(parts, same).select("pid", *keys, "v", "c", (F.col("below") + F.col("__before")).alias("below"), "n")


def quantile_columns(probs: list[float]) -> list[Column]:
    """Aggregates q0, q1, ... over ``running_weights``: exact quantiles with linear
    interpolation between the two nearest ranks."""
    out = []
    for i, p in enumerate(probs):
        place = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.floor(place), F.ceil(place)

        def at(rank):
            return F.max(F.when((F.col("below") <= rank) & (rank < F.col("below") + F.col("c")), F.col("v")))

        share = F.max(place - low)
        out.append((at(low) + (at(high) - at(low)) * share).alias(f"q{i}"))
    return out


def box_stats(df: DataFrame, keys: list[str], value: str, whisker: float = 1.5,
              exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Box-plot statistics per group: min, q1, median, q3, max, and the whiskers
    (lowest / highest value inside ``[q1 - 1.5 IQR, q3 + 1.5 IQR]``) plus the
    number of outliers.

    The rows are read once, to value counts. Exact quartiles (linear interpolation) come
    from running weights over ranges of the values, so a group may hold any number of
    different values; with ``exact`` False they come from ``percentile_approx``, a bounded
    sketch for which the rows are read once more. The whiskers need the fences, which are joined to the
    counts by group and range: a group of any size is dealt over its ranges."""
    rows = running_weights(df, keys, value)
    quartiles = [c.alias(a) for c, a in zip(quantile_columns([0.25, 0.5, 0.75]), ("q1", "median", "q3"), strict=True)]
    stats = rows.groupBy(*keys).agg(F.min("v").alias("min"), *quartiles, F.max("v").alias("max"),
                                    F.max("n").alias("n"))
    if not exact:
        q = F.percentile_approx(F.col(value).cast("double"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy)
        sketch = df.groupBy(*[F.col(k).alias(f"__a{i}") for i, k in enumerate(keys)]).agg(q.alias("__q"))
        stats = stats.join(sketch, [F.col(k).eqNullSafe(F.col(f"__a{i}")) for i, k in enumerate(keys)]).select(
            *keys, "min", *[F.col("__q")[i].alias(a) for i, a in enumerate(("q1", "median", "q3"))], "max", "n")
    iqr = F.col("q3") - F.col("q1")
    kk = [f"__k{i}" for i in range(len(keys))]
    fences = stats.select(*[F.col(k).alias(a) for k, a in zip(keys, kk, strict=True)],
                          (F.col("q1") - whisker * iqr).alias("__lo"), (F.col("q3") + whisker * iqr).alias("__hi"))
    # fences by group and range: as many rows as ranges and groups
    same = [F.col(k).eqNullSafe(F.col(a)) for k, a in zip(keys, kk, strict=True)]
    spread = rows.select("pid", *keys).distinct().join(fences, same).select(
        F.col("pid").alias("__pid"), *kk, "__lo", "__hi")
    inside = (F.col("v") >= F.col("__lo")) & (F.col("v") <= F.col("__hi"))
    whiskers = (rows.join(spread, [F.col("pid") == F.col("__pid"), *same])
                .groupBy(*kk)
                .agg(F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
                     F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
                     F.sum(F.when(~inside, F.col("c")).otherwise(0)).alias("n_outliers")))
    return (stats.join(whiskers, same)
            .select(*keys, "n", "min", "q1", "median", "q3", "max",
                    "whisker_low", "whisker_high", "n_outliers"))


def round_doubles(df: DataFrame, places: int = 6, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Round every DOUBLE column (float sums depend on summation order)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double" and f.name not in exclude:
            cols.append(F.round(F.col(f.name), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


__all__ = ["money_sum", "exact_mean", "count_by", "sum_by", "with_share", "share_by", "top_k",
           "histogram", "running_weights", "quantile_columns", "box_stats", "round_doubles"]
