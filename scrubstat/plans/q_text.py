"""Registered queries for text normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import clean as c
from .registry import make_registry
from .tables import table, view, with_views

Q, q = make_registry()

_WS = r"[\t-\r\x1c-\x20]"


def _fold(e):
    return f"regexp_replace(strip_accents({e}), '[^\\x00-\\x7F]', '', 'g')"


def _strip(e):
    return f"regexp_replace({e}, '^{_WS}+|{_WS}+$', '', 'g')"


def _norm_text(e):
    t = _strip(f"lower({_fold(e)})")
    t = f"regexp_replace({t}, '[^A-Za-z0-9_\\t-\\r\\x1c-\\x20]', ' ', 'g')"
    t = f"regexp_replace({t}, '{_WS}+', '_', 'g')"
    t = f"regexp_replace({t}, '__+', '_', 'g')"
    t = f"regexp_replace({t}, '_$', '')"
    return f"regexp_replace({t}, '__+', '_', 'g')"


def _norm_key(e):
    t = f"lower({_fold(f'coalesce(CAST({e} AS VARCHAR), {chr(39)}{chr(39)})')})"
    t = f"regexp_replace({t}, '[^A-Za-z0-9_\\t-\\r\\x1c-\\x20]', '', 'g')"
    return _strip(f"regexp_replace({t}, '{_WS}+', ' ', 'g')")


@q("normalize_text", with_views(
    f"SELECT id, {_norm_text('segment_raw')} AS segment_raw, {_norm_text('label_raw')} AS label_raw, "
    f"balance FROM dirty", "dirty"))
def _normalize_text(spark, sf):
    d = view(spark, sf, "dirty").select("id", "segment_raw", "label_raw", "balance")
    return c.normalize_string_format(d)


@q("normalize_key", f"SELECT doc_id, {_norm_key('text')} AS k FROM documents")
def _normalize_key(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", tx.normalize_key(F.col("text")).alias("k"))


@q("fold_ascii", f"SELECT doc_id, {_fold('text')} AS folded FROM documents")
def _fold_ascii(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", tx.fold_ascii(F.col("text")).alias("folded"))


@q("tokenize", "SELECT doc_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}_]+', '', 'g') AS "
   "squashed, regexp_extract_all(lower(text), '[a-z0-9]+') AS tokens FROM documents")
def _tokenize(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", tx.squash(F.col("text")).alias("squashed"),
                    tx.tokens(F.col("text")).alias("tokens"))
