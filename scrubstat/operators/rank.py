"""G1: global order without a one-task window, and exact quantiles built on it.

A window with no PARTITION BY runs in a single task. Instead the ordered domain is cut into
buckets at explicit boundaries (approximate percentiles for one numeric column, a bounded sample
for composite keys), each bucket is ordered by its own window, and bucket offsets come from a
tiny table of per-bucket totals. Boundaries are collected as literals, so a recomputed task sees
exactly the same buckets.

For statistics the rows are first collapsed to (value, count): ties cost nothing and a value that
holds a third of the table is one row, so no bucket grows with a hot value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_through


def default_buckets(df: DataFrame) -> int:
    """Two buckets for each shuffle partition, the setting that follows the size of the data."""
    return max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def _search(key: Column, bounds: Sequence[Column]) -> Column:
    """Number of boundaries <= key (bounds sorted ascending): a balanced CASE tree, or, where that would
    outgrow generated code, the same search over an array."""
    n = len(bounds)
    if n > 512:
        at, step, steps = F.array(*bounds), 1 << (n.bit_length() - 1), []
        while step:
            steps.append(F.lit(step))
            step >>= 1
        found = F.aggregate(F.array(*steps), F.lit(0), lambda a, s: F.when(
            (a + s <= n) & (F.get(at, a + s - 1) <= key), a + s).otherwise(a))
        return F.when(key.isNotNull(), found).otherwise(F.lit(0))

    def rec(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= bounds[mid], rec(mid + 1, hi)).otherwise(rec(lo, mid))

    return rec(0, len(bounds))


def _value_cuts(df: DataFrame, col: str, buckets: int, dt: T.DataType) -> list[Column]:
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(F.col(col), probs, 10000).alias("c")).first()
    cuts = sorted(set(row["c"] or []))
    return [F.lit(c).cast(dt) for c in cuts]


def ranked_counts(df: DataFrame, value: str, by: Sequence[str] = (),
                  buckets: int | None = None) -> DataFrame:
    """Collapse `value` to distinct values per group with their position in the sorted order.

    Returns (by..., value, cnt, start, n): `start` is the 0-based position of the first row
    holding `value` within its group, `n` the group's non-null row count.
    """
    by = list(by)
    dt = df.schema[value].dataType
    base = df.select(*by, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        base = base.where(~F.isnan("_v"))
    b = buckets or default_buckets(df)
    cuts = _value_cuts(base, "_v", b, dt)
    counted = (base.withColumn("_b", _search(F.col("_v"), cuts))
               .groupBy(*by, "_b", "_v").agg(F.count(F.lit(1)).alias("cnt")))
    totals = counted.groupBy(*by, "_b").agg(F.sum("cnt").alias("_bt"))
    wt = Window.partitionBy(*by).orderBy("_b") if by else Window.orderBy("_b")
    wn = Window.partitionBy(*by) if by else Window.partitionBy()
    totals = totals.select(*by, "_b",
                           (F.sum("_bt").over(wt.rowsBetween(Window.unboundedPreceding, 0))
                            - F.col("_bt")).alias("_off"),
                           F.sum("_bt").over(wn).alias("n"))
    wv = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    within = counted.withColumn("_cum", F.sum("cnt").over(wv))
    out = within.join(totals, on=[*by, "_b"], how="inner")
    return out.select(*by, F.col("_v").alias(value), "cnt",
                      (F.col("_off") + F.col("_cum") - F.col("cnt")).alias("start"), "n")


def global_rank(df: DataFrame, order_cols: Sequence[str], by: Sequence[str] = (),
                name: str = "rank", buckets: int | None = None) -> DataFrame:
    """Row number (1-based) by `order_cols` within `by` groups (whole table when empty).

    The input is written once to the shared scratch folder: counting, cutting, numbering and totals
    read that table. Ties are broken by a hash of the row and its place there, so boundaries split
    a run of equal keys, and of identical rows, and neither lands in one task.
    """
    by = list(by)
    order_cols = list(order_cols)
    keyed = write_through(df.withColumn("_tb", F.xxhash64(*[F.col(c) for c in df.columns], F.monotonically_increasing_id())), "rank")
    keys = order_cols + ["_tb"]
    types = {f.name: f.dataType for f in keyed.schema}
    b = buckets or default_buckets(df)
    n = keyed.count()
    bounds: list[Column] = []
    if n > 0:
        frac = min(1.0, 64.0 * b / n)
        sample = keyed.sample(False, frac, seed=17).select(*keys).orderBy(*keys).collect()  # about 64 rows a bucket
        if sample:
            step = max(1, len(sample) // b)
            picked = sample[step::step][: b - 1]
            for row in picked:
                bounds.append(F.struct(*[F.lit(row[k]).cast(types[k]).alias(f"k{i}")
                                         for i, k in enumerate(keys)]))
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    bucketed = keyed.withColumn("_b", _search(key, bounds) if bounds else F.lit(0))
    w = Window.partitionBy(*by, "_b").orderBy(*keys)
    numbered = bucketed.withColumn("_rn", F.row_number().over(w))
    totals = bucketed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_bt"))
    wt = Window.partitionBy(*by).orderBy("_b") if by else Window.orderBy("_b")
    totals = totals.select(*by, "_b", (F.sum("_bt").over(
        wt.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_bt")).alias("_off"))
    out = numbered.join(totals, on=[*by, "_b"], how="inner")
    return out.select(*df.columns, (F.col("_off") + F.col("_rn")).cast("long").alias(name))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, buckets: int | None = None) -> DataFrame:
    """A5: quantiles with linear interpolation (numpy / pandas default), exact and distributed.

    Rows are bucketed at approximate cut points and only counted per bucket (a tiny table).
    The target positions floor/ceil((n-1) p) fall into at most two buckets per probability;
    only rows of those buckets (a semi-join on the small bucket list) are ranked, so the sort
    touches about 2 * len(probs) / buckets of the data. Within them the (at most two) values
    straddling each position are picked and interpolated.
    """
    by = list(by)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    dt = df.schema[value].dataType
    base = df.select(*by, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        base = base.where(~F.isnan("_v"))
    b = buckets or default_buckets(df)
    cuts = _value_cuts(base, "_v", b, dt)
    bucketed = base.withColumn("_b", _search(F.col("_v"), cuts))
    counts = bucketed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_bt"))
    wt = Window.partitionBy(*by).orderBy("_b") if by else Window.orderBy("_b")
    wn = Window.partitionBy(*by) if by else Window.partitionBy()
    counts = counts.select(*by, "_b", "_bt",
                           (F.sum("_bt").over(wt.rowsBetween(Window.unboundedPreceding, 0))
                            - F.col("_bt")).alias("_off"),
                           F.sum("_bt").over(wn).alias("_n"))
    lo_hi = []
    for p in probs:
        h = (F.col("_n") - 1) * F.lit(float(p))
        lo_hi += [F.floor(h), F.ceil(h)]
    inside = [(F.col("_off") <= t) & (t < F.col("_off") + F.col("_bt")) for t in lo_hi]
    hit = inside[0]
    for c in inside[1:]:
        hit = hit | c
    needed = counts.where(hit).select(*by, "_b", "_off", "_n")
    part = bucketed.join(needed, [*by, "_b"], "inner")
    vc = part.groupBy(*by, "_b", "_off", "_n", "_v").agg(F.count(F.lit(1)).alias("cnt"))
    wv = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    vc = vc.withColumn("start", F.col("_off") + F.sum("cnt").over(wv) - F.col("cnt"))
    v = F.col("_v").cast("double")
    start, end = F.col("start"), F.col("start") + F.col("cnt") - 1
    aggs = []
    for p, nm in zip(probs, names):
        h = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [F.max(F.when((start <= lo) & (end >= lo), v)).alias(f"_lo_{nm}"),
                 F.max(F.when((start <= hi) & (end >= hi), v)).alias(f"_hi_{nm}"),
                 F.max(h - lo).alias(f"_d_{nm}")]
    picked = vc.groupBy(*by).agg(*aggs)
    return picked.select(*by, *[
        (F.col(f"_lo_{nm}") + F.col(f"_d_{nm}") * (F.col(f"_hi_{nm}") - F.col(f"_lo_{nm}")))
        .alias(nm) for nm in names])
