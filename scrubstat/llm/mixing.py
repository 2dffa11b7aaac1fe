"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a fixed pseudo-random order, offered up to `repeats`
times. An item's virtual finish time is its source's cumulative tokens, itself included, divided by
the source's target. Served in the order of finish times, all queues progress in proportion to
their targets, and the budget (the sum of the targets) is spent at virtual time 1: items that
finish later are cut off, and of a source's item in service at that time the words up to its
target are taken. Targets share the budget by weight; none exceeds `repeats` times its source's size,
and the excess is shared anew by weight (water filling).

Native: DataFrame and SQL functions only. The cumulative sums run in ranges of the shuffle key:
a table of n rows has sqrt(n) ranges per source, so neither a window nor the table of range totals
grows faster than sqrt(n) and a hot source is split like any other. Only the table of sources is
ordered in one task.

Defined results: null text has size 0; null is a source of its own, the last; ids may be null or
repeated (each row is an item of its own); rows equal in all columns swap places freely; an empty
table or sizes that are all 0 give targets 0 and nothing taken; other columns are ignored or, with
`keep_rows`, carried in a struct.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_through

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def source_targets(totals: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """(skey, source_size, target) from (skey, source, source_size); weights repeat over the
    sources in code point order, null last."""
    # Over the table of sources, which is one row per source.
    cycle = F.array(*[F.lit(w) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    t = totals.withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1)))
    t = t.withColumn("cap", repeats * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    capped = F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1))
    lighter = F.sum("w").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1))
    t = t.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(capped, F.lit(0)))
                     / (F.sum("w").over(every) - F.coalesce(lighter, F.lit(0))))
    t = t.withColumn("at", F.row_number().over(by_ratio))
    level = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")),
                     F.when(F.col("level") <= F.col("ratio"), F.col("at"))).over(every)
    t = t.withColumn("share", level * F.col("w"))
    return t.select("skey", "source_size", F.when(F.col("cap") <= F.col("share"), F.col("cap").cast("double"))
                    .otherwise(F.col("share")).alias("target"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = WEIGHTS, repeats: int = 3, seed: str = "",
             keep_rows: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and `items`, an array of
    struct(epoch, finish, words) of the served items; with `keep_rows` also `row`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    cols = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("null")).alias("skey"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(seed), ident, F.lit(":"), text)).alias("u")]
    if keep_rows:
        cols.append(F.struct("*").alias("row"))
    rows = write_through(docs.select(*cols), "mix-items")
    ranges = max(1, math.isqrt(rows.count()))
    rows = rows.withColumn("range", F.expr(f"cast(conv(substr(u, 1, 8), 16, 10) as bigint) * {ranges} div 4294967296"))
    totals = rows.groupBy("skey", "range").agg(F.first("source").alias("source"), F.sum("size").alias("n"))
    targets = source_targets(totals.groupBy("skey").agg(F.first("source").alias("source"),
                                                        F.sum("n").alias("source_size")), weights, repeats)
    earlier = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.select("skey", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
               .join(targets, "skey"))
    queue = (Window.partitionBy("skey", "range").orderBy("u", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, 0))
    placed = (rows.withColumn("before", F.sum("size").over(queue) - F.col("size"))
              .join(offsets, ["skey", "range"])
              .withColumn("before", F.col("before") + F.col("offset"))
              .withColumn("limit", F.round("target").cast("long")))
    items = F.expr(f"""filter(transform(sequence(0, {repeats - 1}), e -> named_struct(
        'epoch', e, 'finish', try_divide(e * source_size + before + size, target),
        'words', greatest(0L, least(size, limit - e * source_size - before)))), i -> i.words > 0)""")
    placed = placed.withColumn("items", items)
    return placed.select("doc_id", "size", "source_size", "target",
                         F.expr("aggregate(items, 0L, (a, i) -> a + i.words)").alias("taken"),
                         "items", *["row"] * keep_rows)


def first_words(text: Column, size: Column, words: Column) -> Column:
    """The text up to its `words`-th word; unchanged if that is all of them."""
    parts = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(words == size, text).otherwise(F.array_join(F.slice(parts, 1, words.cast("int")), ""))


def mix_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is served, globally range-sorted
    by virtual finish time, the last item of a source cut to the words it still gets."""
    plan = mix_plan(docs, text_col=text_col, keep_rows=True, **options)
    served = plan.select("row", "size", F.explode("items").alias("item")).orderBy("item.finish", "item.epoch")
    return served.select(*[
        first_words(F.col(f"row.`{c}`"), F.col("size"), F.col("item.words")).alias(c) if c == text_col
        else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
