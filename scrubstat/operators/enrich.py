"""Lookup enrichment (E1-E5), re-aimed from one HTTP call per key to joins over a page corpus.

keys (E1) -> search phrase (E2) -> best matching page by shared tokens (E5) -> year found in the
page text (E3) -> joined back onto every row with a fallback (E4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import move_to_end
from ..session import write_through
from .dedupe import HOT_KEY_ROWS

# (?d): only \n ends a line, as for Python's `.`; (?i) ignore case; first match wins.
YEAR_PATTERN = r"(?di)released?.*?(\d{4})"


def lookup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key combination once."""
    return df.select(*keys).distinct()


def search_phrase(name: Column, platform: Column) -> Column:
    """Name with `_` as spaces, then the platform."""
    return F.concat_ws(" ", F.replace(name, F.lit("_"), F.lit(" ")), platform)


def release_year(text: Column) -> Column:
    """First four-digit number after 'release'/'released' on the same line, else NULL."""
    y = F.regexp_extract(text, YEAR_PATTERN, 1)
    return F.when(y != "", y.cast("int"))


def page_text(html: Column) -> Column:
    """Visible text of a page: tags replaced by spaces."""
    return F.regexp_replace(html, r"<[^>]*>", " ")


def best_page_match(keys: DataFrame, phrase: str, pages: DataFrame, page_id: str = "page_id",
                    text: str = "text", hot: int = HOT_KEY_ROWS) -> DataFrame:
    """E5: for each phrase the page sharing the most distinct tokens (ties: smallest page id).

    A token that more than `hot` pages hold is common. Phrases first meet pages on their other tokens. Where the best
    page shares more of these than the phrase has common tokens, c, no page known by common tokens alone can
    win or tie; the common tokens are then only counted for pages within c of the best. Only the phrases
    that stay open meet pages on their common tokens too, split over several tasks a token. So common words do not
    pair all phrases with all pages, and no answer changes. Keys without any shared token get no row.
    Output: (key columns..., page_id, score).
    """
    kcols = [c for c in keys.columns]
    words = lambda c: F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(c)), F.lit("[a-z0-9]+"), 0)))
    ptok = pages.select(F.col(page_id).alias("_pid"), words(text).alias("token"))
    freq = write_through(ptok.groupBy("token").agg(F.count(F.lit(1)).alias("_m")), "page-tokens")
    # the key as a struct: its nulls compare equal
    ktok = write_through(keys.select(F.struct(*kcols).alias("_k"), words(phrase).alias("token")).join(freq, "token"), "key-tokens")
    common = F.col("_m") > hot

    def meet(tokens: DataFrame) -> DataFrame:
        buckets = F.ceil(F.col("_m") / hot).cast("long")
        ps = ptok.join(freq, "token").select("token", "_pid", F.pmod(F.xxhash64("_pid"), buckets).alias("_salt"))
        ks = tokens.select("_k", "token", F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)).alias("_salt"))
        return ks.join(ps, ["token", "_salt"]).groupBy("_k", "_pid").agg(F.count(F.lit(1)).alias("score"))

    rare = write_through(meet(ktok.where(~common)), "page-scores")
    state = write_through(ktok.groupBy("_k").agg(F.count_if(common).alias("_c")).join(
        rare.groupBy("_k").agg(F.max("score").alias("_best")), "_k", "left")
        .withColumn("_open", (F.col("_c") > 0) & (F.coalesce("_best", F.lit(0)) <= F.col("_c"))), "key-state")
    near = rare.join(state.where("not _open"), "_k").where("score >= _best - _c")
    more = (near.join(ktok.where(common).select("_k", "token"), "_k").join(ptok, ["_pid", "token"])
            .groupBy("_k", "_pid").agg(F.count(F.lit(1)).alias("_more")))
    settled = near.join(more, ["_k", "_pid"], "left").select(
        "_k", "_pid", (F.col("score") + F.coalesce("_more", F.lit(0))).alias("score"))
    opened = meet(ktok.join(state.where("_open").select("_k"), "_k"))
    # best = highest score, then smallest page id; an aggregate (partial per task) rather
    # than a window, so a key with many candidate pages never sits in one partition
    best = settled.unionByName(opened).groupBy("_k").agg(
        F.min_by("_pid", F.struct((-F.col("score")).alias("s"), F.col("_pid").alias("p")))
        .alias("_pid"), F.max("score").alias("score"))
    return best.select("_k.*", F.col("_pid").alias(page_id), "score")


def lookup_years(keys: DataFrame, name: str, platform: str, pages: DataFrame, page_id: str = "page_id",
                 html: str = "html") -> DataFrame:
    """(name, platform, _year) for the key combinations that find a page."""
    asked = keys.withColumn("_phrase", search_phrase(F.col(name), F.col(platform)))
    pg = pages.select(F.col(page_id), page_text(F.col(html)).alias("_text"), F.col(html))
    best = best_page_match(asked, "_phrase", pg.select(page_id, F.col("_text").alias("text")),
                           page_id)
    return (best.join(pg.select(page_id, html), page_id)
            .select(name, platform, release_year(F.col(html)).alias("_year")))


def enrich_lookup(df: DataFrame, name: str, platform: str, pages: DataFrame,
                  page_id: str = "page_id", html: str = "html",
                  out: str = "release_year") -> DataFrame:
    """E1-E5 end to end: one lookup per distinct (name, platform), joined back with
    'unknown' as fallback; the new column goes last, plus a typed `<out>_int`."""
    years = lookup_years(lookup_keys(df, [name, platform]), name, platform, pages, page_id, html)
    j = df.join(years, [name, platform], "left")
    res = j.select(*df.columns, F.coalesce(F.col("_year").cast("string"), F.lit("unknown"))
                   .alias(out), F.col("_year").alias(f"{out}_int"))
    return move_to_end(move_to_end(res, out), f"{out}_int")
