"""Threshold-scaled document sketches (fractional min-hash).

A sketch keeps every hash of a text's word shingles below a fixed fraction of the hash range, so sketches of
texts of any size compare and merge: the union of two sketches is the sketch of both texts together, and the
share of one's hashes found in the other estimates containment. The fraction, one half, is the same for every text: a
text of n shingles keeps about n / 2, and an estimate over m kept hashes errs by about 0.5 / sqrt(m), so
those of texts of a few words are rough. Where neither of two texts keeps a hash, they are alike 1 if equal, else 0.

`fingerprint` writes a sketch as text: its hashes in hex, ascending.

Native: DataFrame and SQL functions only. The next document by id comes from one shuffle into id ranges; rows
that open a range go to the range before it as well.

Defined results: null text is empty and has the empty sketch; texts of fewer words than a shingle have one shingle, the whole sequence; null ids come
last (in the last range); among rows of one id the order is by text; the only row of a table is its own next
document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE, FRACTION = 5, 2  # one hash in FRACTION is kept
TOP = (1 << 63) - 1  # hashes have 63 bits
LIMIT = (1 << 63) // FRACTION
ROWS_PER_RANGE, MOST_RANGES = 2000, 20_000
SPACE = " \t\n\x0b\x0c\r"


def add_sketch(df: DataFrame, text: str, out: str, n: int = SHINGLE) -> DataFrame:
    """df with `out`, an array<bigint> over its column `text` (no nulls): the kept hashes, ascending. Words hash once; a
    shingle hashes its words' hashes."""
    trimmed = F.btrim(F.lower(text), F.lit(SPACE))
    words = F.when(trimmed == "", F.expr("cast(array() as array<string>)")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))
    h, count = F.col("_h"), F.size("_h")
    shingles = F.when(count < n, F.array(F.aggregate(h, F.lit(n).cast("long"), lambda a, x: F.xxhash64(a, x)))).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(count - n, F.lit(0))),
                    lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)])))
    kept = F.filter(F.transform(shingles, lambda x: x.bitwiseAND(F.lit(TOP))), lambda x: x < LIMIT)
    return (df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
            .withColumn(out, F.when(count == 0, F.expr("cast(array() as array<bigint>)")).otherwise(
                F.array_sort(F.array_distinct(kept))))
            .drop("_h"))


def add_likeness(df: DataFrame, a: str, b: str, jaccard: str, contained: str, equal: Column) -> DataFrame:
    """df with the estimated Jaccard similarity of the texts of sketches a and b, and the share of a in b; `equal` says
    whether the texts are, for sketches without hashes."""
    same = F.when(equal, F.lit(1.0)).otherwise(F.lit(0.0))
    out = df.withColumn("_both", F.size(F.array_intersect(a, b)))
    union = F.size(a) + F.size(b) - F.col("_both")
    return (out.withColumn(jaccard, F.when(union == 0, same).otherwise(F.try_divide(F.col("_both"), union).cast("double")))
            .withColumn(contained, F.when(F.size(a) == 0, same).otherwise(F.try_divide(F.col("_both"), F.size(a)).cast("double")))
            .drop("_both"))


def fingerprint(s: Column) -> Column:
    """A sketch as text."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts together."""
    return F.array_sort(F.array_union(a, b))


def with_next(rows: DataFrame, id_col: str, tie: str, cols: list[str]) -> DataFrame:
    """rows plus `next_<c>` for each of `cols`: the value in the row with the next id (after the last: the
    first), by a window in each of many id ranges."""
    n = rows.count()
    ranges = max(1, min(MOST_RANGES, -(-n // ROWS_PER_RANGE)))
    cuts = rows.agg(F.percentile_approx(id_col, [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges + 1000).alias("c"),
                    F.min(id_col).alias("lo")).first()  # at most MOST_RANGES ids
    bounds = sorted(set(cuts["c"] or []) - {cuts["lo"]}) if ranges > 1 else []
    last = len(bounds)
    rid = F.col(id_col)
    if bounds:
        at = F.array(*[F.lit(b) for b in bounds])
        # Binary search: the number of bounds not above the id.
        step = 1 << (last.bit_length() - 1)
        found, steps = F.lit(0), []
        while step:
            steps.append(step)
            step >>= 1
        found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda a, s: F.when(
            (a + s <= last) & (F.get(at, a + s - 1) <= rid), a + s).otherwise(a))
        own = F.when(rid.isNull(), F.lit(last)).otherwise(found)
        opens = F.get(at, F.col("_range") - 1) == rid
    else:
        own, opens = F.lit(0), F.lit(False)
    place = lambda r, guest, wrap: F.struct(r.alias("range"), F.lit(guest).alias("guest"), F.lit(wrap).alias("wrap"))
    first = F.lit(True) if cuts["lo"] is None else rid == F.lit(cuts["lo"])
    spread = rows.withColumn("_range", own).withColumn("_at", F.explode(F.array_compact(F.array(
        place(F.col("_range"), False, False), F.when(opens, place(F.col("_range") - 1, True, False)),
        F.when(first, place(F.lit(last), True, True))))))
    w = Window.partitionBy("_at.range").orderBy("_at.wrap", rid.asc_nulls_last(), tie)
    out = spread.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in cols])
    return out.where("not _at.guest").drop("_range", "_at")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, the edited text (its last half replaced by the start of the next document's),
    the sketches of both, and likeness and containment to the edited text and the next document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(add_sketch(rows, "text", "sketch"), "doc_id", "text", ["text", "sketch"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.expr(
        "concat(left(text, cast(n_chars - n_chars div 2 as int)), left(next_text, cast(n_chars div 2 as int)))"))
    rows = (rows.withColumn("_same_edited", F.col("text") == F.col("edited")).withColumn("_same_next", F.col("text") == F.col("next_text"))
            .drop("text", "next_text"))
    rows = add_sketch(rows, "edited", "edited_sketch")
    rows = add_likeness(rows, "sketch", "edited_sketch", "near_edited", "contained_edited", F.col("_same_edited"))
    rows = add_likeness(rows, "sketch", "next_sketch", "near_next", "contained_next", F.col("_same_next"))
    return rows.drop("next_sketch", "_same_edited", "_same_next")
