"""Secret scans through a trigram inverted index.

From each rule's regex a Boolean trigram query is derived: an OR of ANDs of three-character
pieces that any match must hold. `trigram_postings` lists, for every trigram some rule asks for,
the documents that hold it; `candidates` intersects the postings by each query. Only candidates are
verified with their regex; a rule whose regex has no mandatory trigram scans every text.

Native: DataFrame and SQL functions only; the rules are analysed on the driver.

Defined results: null text is empty; rows with a null id keep their own row (ids join null-safe);
rows that share an id share candidates and are verified each on its own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re._constants as K
import re._parser as parser
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import no_spans, regex_spans

# Fixed values of the base rules: (kind, regex, condition on a match). x.v is the second group.
BASE_RULES = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     "length(x.v) >= 12"),
    ("access", r"AKIA[A-Z0-9]{14,}+", "true"),
    ("hex", r"[0-9a-f]{16,}+", "true"),
]
# Public formats of well-known credentials. Repeated groups are possessive: others recurse, and a long text would
# exhaust the stack.
MORE_RULES = [
    ("private_key", r"-----BEGIN (?:(?!PRIVATE KEY-----)[A-Z]++ )*+PRIVATE KEY-----", "true"),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}+", "true"),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+", "true"),
    ("google", r"AIza[A-Za-z0-9_-]{35}", "true"),
    ("stripe", r"sk_live_[A-Za-z0-9]{16,}+", "true"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", "true"),
]
RULES = BASE_RULES + MORE_RULES
ANY = frozenset([frozenset()])  # the query that every text meets
MOST_STRINGS, MOST_CHARS = 64, 8


def absorb(query) -> frozenset:
    """Drop the alternatives that another one implies."""
    return frozenset(a for a in query if not any(b < a for b in query))


def both(a, b) -> frozenset:
    return absorb({x | y for x in a for y in b})


def needed(strings) -> frozenset:
    """One of these strings must occur."""
    return absorb({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings})


def analyse(items) -> tuple:
    """(strings, query) of a parsed regex: all strings it matches if these are few, else None;
    and the trigram query that any match meets."""
    so_far, query, whole = {""}, ANY, True
    for op, arg in items:
        strings, own = _item(op, arg)
        if strings is not None and len(strings) * len(so_far) <= MOST_STRINGS:
            so_far = {a + b for a, b in product(so_far, strings)}
            continue
        query = both(both(query, needed(so_far)), own)
        so_far, whole = (set(strings), False) if strings is not None else ({""}, False)
    return (so_far if whole else None), both(query, needed(so_far))


def _item(op, arg) -> tuple:
    if op is K.LITERAL:
        return {chr(arg).lower()}, ANY
    if op is K.IN:
        chars = set()
        for kind, v in arg:
            if kind is K.LITERAL:
                chars.add(chr(v).lower())
            elif kind is K.RANGE and v[1] - v[0] < MOST_CHARS:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, ANY
        return (chars, ANY) if len(chars) <= MOST_CHARS else (None, ANY)
    if op is K.SUBPATTERN:
        return analyse(arg[3])
    if op is K.BRANCH:
        parts = [analyse(p) for p in arg[1]]
        query = absorb(frozenset().union(*(q for _, q in parts)))
        if any(s is None for s, _ in parts):
            return None, query
        return set().union(*(s for s, _ in parts)), query
    if op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        low, high, inner = arg
        strings, query = analyse(inner)
        if high == 1 and strings is not None:
            return strings | ({""} if low == 0 else set()), ANY
        return None, query if low else ANY
    return None, ANY


def trigram_query(regex: str) -> frozenset:
    """The Boolean trigram query of a regex, an OR of ANDs, in lower case."""
    return analyse(parser.parse(regex))[1]


def trigram_postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index (trigram, doc_id) of docs(doc_id, text) for the given trigrams."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    return low.select("doc_id", F.explode(F.array_compact(held)).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, frozenset]) -> DataFrame:
    """(doc_id, kinds): the rules whose trigram query the document's postings meet."""
    held = postings.groupBy("doc_id").agg(F.collect_set("trigram").alias("held"))

    def meets(query) -> Column:
        parts = [F.array_size(F.array_except(F.array(*map(F.lit, sorted(a))), "held")) == 0 for a in query]
        out = parts[0]
        for p in parts[1:]:
            out = out | p
        return out

    kinds = F.array_compact(F.array(*[F.when(meets(q), F.lit(k)) for k, q in queries.items()]))
    return held.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules=RULES) -> DataFrame:
    """doc_id, text, spans (array of structs of `spans.SPAN`) for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    queries = {kind: trigram_query(regex) for kind, regex, _ in rules}
    indexed = {k: q for k, q in queries.items() if q != ANY}
    grams = sorted({t for q in indexed.values() for a in q for t in a})
    if grams:
        found = candidates(trigram_postings(rows, grams), indexed).withColumnRenamed("doc_id", "_id")
        rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    parts = []
    for rank, (kind, regex, keep) in enumerate(rules):
        spans = regex_spans("text", regex, kind, rank, keep, groups="x.v" in keep)
        if kind in indexed:
            spans = F.when(F.array_contains("kinds", kind), spans).otherwise(no_spans())
        parts.append(spans)
    return rows.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("spans"))
