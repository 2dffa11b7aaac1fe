"""Registered queries for lookup enrichment (E1-E5) and P7."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import enrich as en
from ..operators.kept import category_table, encode, enrich_kept
from ..session import scratch_path, write_through
from .registry import make_registry
from .tables import table

Q, q = make_registry()

_YEAR = "CAST(nullif(regexp_extract({c}, 'released?.*?(\\d{{4}})', 1, 'i'), '') AS INTEGER)"


@q("lookup_keys", "SELECT DISTINCT p_name, p_brand FROM part")
def _lookup_keys(spark, sf):
    return en.lookup_keys(table(spark, sf, "part"), ["p_name", "p_brand"])


@q("search_phrase", "SELECT DISTINCT p_name, p_brand, concat_ws(' ', replace(p_name, '_', ' '), "
                    "p_brand) AS phrase FROM part")
def _search_phrase(spark, sf):
    k = en.lookup_keys(table(spark, sf, "part"), ["p_name", "p_brand"])
    return k.withColumn("phrase", en.search_phrase(F.col("p_name"), F.col("p_brand")))


@q("release_year_extract", f"SELECT page_id, {_YEAR.format(c='html')} AS release_year FROM pages")
def _release_year_extract(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", en.release_year(F.col("html")).alias("release_year"))


@q("release_year_documents",
   f"SELECT doc_id, {_YEAR.format(c='text')} AS release_year FROM documents")
def _release_year_documents(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", en.release_year(F.col("text")).alias("release_year"))


_BEST = (
    "k AS (SELECT DISTINCT p_name, p_brand, concat_ws(' ', replace(p_name, '_', ' '), p_brand) AS "
    "phrase FROM part), kt AS (SELECT DISTINCT p_name, p_brand, unnest(regexp_extract_all("
    "lower(phrase), '[a-z0-9]+')) AS token FROM k), pt AS (SELECT DISTINCT page_id, unnest("
    "regexp_extract_all(lower(regexp_replace(html, '<[^>]*>', ' ', 'g')), '[a-z0-9]+')) AS token "
    "FROM pages), s AS (SELECT p_name, p_brand, page_id, count(*) AS score FROM kt JOIN pt USING "
    "(token) GROUP BY ALL), best AS (SELECT p_name, p_brand, page_id, CAST(score AS BIGINT) AS "
    "score FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY score DESC, "
    "page_id) AS rn FROM s) r WHERE rn = 1)")


@q("best_page_match", f"WITH {_BEST} SELECT * FROM best")
def _best_page_match(spark, sf):
    k = en.lookup_keys(table(spark, sf, "part"), ["p_name", "p_brand"]).withColumn(
        "phrase", en.search_phrase(F.col("p_name"), F.col("p_brand")))
    pages = table(spark, sf, "pages").select(
        "page_id", en.page_text(F.col("html")).alias("text"))
    return en.best_page_match(k.select("p_name", "p_brand", "phrase"), "phrase", pages).drop(
        "phrase")


_LOOKUP_SQL = (
    f"WITH {_BEST}, y AS (SELECT best.p_name, best.p_brand, {_YEAR.format(c='pages.html')} AS yr "
    f"FROM best JOIN pages USING (page_id)) SELECT part.*, coalesce(CAST(y.yr AS VARCHAR), "
    f"'unknown') AS release_year, y.yr AS release_year_int FROM part LEFT JOIN y USING "
    f"(p_name, p_brand)")


@q("enrich_kept", _LOOKUP_SQL)
def _enrich_kept(spark, sf):
    """A run over the parts of half the brands, then one over all, which looks up the other half alone."""
    folder = scratch_path(spark, f"lookups-{uuid.uuid4().hex}")
    part, pages = table(spark, sf, "part"), table(spark, sf, "pages")
    enrich_kept(part.where("p_brand < 'Brand#3'"), "p_name", "p_brand", pages, folder)
    return enrich_kept(part, "p_name", "p_brand", pages, folder)


_PART_COLS = ["p_name", "p_brand", "p_type"]


@q("category_codes_joint", "SELECT p_partkey, p_name, p_brand, p_type, " + ", ".join(
   f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_code" for c in _PART_COLS) + " FROM part")
def _category_codes_joint(spark, sf):
    """Codes of several columns from one ranking."""
    part = table(spark, sf, "part").select("p_partkey", *_PART_COLS)
    return encode(part, _PART_COLS, write_through(category_table(part, _PART_COLS), "codes"))


@q("enrich_lookup", _LOOKUP_SQL)
def _enrich_lookup(spark, sf):
    return en.enrich_lookup(table(spark, sf, "part"), "p_name", "p_brand",
                            table(spark, sf, "pages"))
