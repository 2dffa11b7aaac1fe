"""Personal data by weak supervision.

Spans of the base kinds come from strict patterns. Further candidates (numbers and names in looser
forms) and the base spans get votes (1, 0, -1) from three labelers: a format regex, a gazetteer
and the words around. Expectation-maximisation over the vote patterns estimates how reliable each
labeler is and how likely each pattern is personal data; with these soft labels a naive Bayes
classifier over votes and surroundings is trained, which decides on the further candidates. Base
spans always stay.

Native: DataFrame and SQL functions only. The driver sees vote patterns and feature totals,
whose number is bounded by kinds x votes and kinds x features x values, never spans.

Defined results: null text is empty; null and repeated ids keep their rows (no join is made); an
empty table gives no rows; with no candidates the model is its prior.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_through
from .spans import clear_of, no_spans, quoted, regex_spans

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_DIGITS = r"translate(x.m, ' -', '')"
_LUHN = f"""aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s + if(i % 2 = 1,
  cast(substr({_DIGITS}, -i, 1) as int),
  cast(substr('0246813579', cast(substr({_DIGITS}, -i, 1) as int) + 1, 1) as int))) % 10 = 0"""

# Fixed values of the base kinds: (kind, regex, condition on a match). Possessive quantifiers and the
# run-start lookbehinds only spare backtracking; they change no match.
BASE_KINDS = [
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
     f"x.m rlike {quoted(f'^{_OCTET}(?:[.]{_OCTET}){{3}}$')}"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++",
     f"case when length({_DIGITS}) between 14 and 19 then {_LUHN} else false end"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
     "length(translate(x.m, '+ ().-', '')) between 10 and 15"),
]
# Looser candidates of the method; the trained classifier decides on them.
MORE_KINDS = [
    ("local_phone", r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])", "true"),
    ("national_id", r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "true"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", "true"),
    ("masked_email", r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+(?: ?[(\[]dot[)\]] ?[A-Za-z]{2,}+)++", "true"),
    ("name", r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr)\.? [A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30})?(?![a-z])", "true"),
]
KINDS = BASE_KINDS + MORE_KINDS
# What any match of a kind holds; texts without it are not searched for the kind.
NEEDS = {
    "email": "contains({0}, '@')", "phone": "contains({0}, '+')", "ip": "{0} rlike '[0-9][.][0-9]'",
    "card": "{0} rlike '[0-9][ -]?[0-9]'", "local_phone": "{0} rlike '[0-9][.-][0-9]{{4}}'",
    "national_id": "{0} rlike '[0-9]-[0-9]{{2}}-[0-9]'", "iban": "{0} rlike '[A-Z]{{2}}[0-9]{{2}}'",
    "masked_email": "(contains({0}, 'at)') or contains({0}, 'at]'))",
    "name": "(contains({0}, 'Mr') or contains({0}, 'Ms') or contains({0}, 'Dr'))",
}


# Labelers: one SQL condition for a vote of 1 and one for -1, over a span `c`: its text
# `c.found`, the lower-case text before (`c.b`, 40 characters) and after (`c.a`, 20). Base kinds have passed their format.
_IBAN = "concat(substr(replace(c.found, ' ', ''), 5), substr(c.found, 1, 4))"
_MOD97 = f"""aggregate(sequence(1, length({_IBAN})), 0, (s, i) -> if(
  substr({_IBAN}, i, 1) between '0' and '9', (s * 10 + ascii(substr({_IBAN}, i, 1)) - 48) % 97,
  (s * 100 + ascii(substr({_IBAN}, i, 1)) - 55) % 97)) = 1"""
FORMAT = {
    "email": ("true", "false"), "ip": ("true", "false"), "card": ("true", "false"),
    "phone": ("true", "false"),
    "local_phone": ("c.found rlike '^[(]?[2-9][0-9]{2}[)]?[ .-][2-9][0-9]{2}[.-]'", "c.found rlike '^[(]?[01]'"),
    "national_id": ("c.found rlike '^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)'",
                    "c.found rlike '^(?:000|666|9)|-00-|-0000$'"),
    "iban": (_MOD97, f"not ({_MOD97})"),
    "masked_email": ("c.found rlike '(?i)[a-z]$'", "false"),
    "name": ("c.found rlike ' [A-Z][a-z]+ [A-Z][a-z]+$'", "false"),
}
GAZETTEER = {
    "email": ("c.found rlike '(?i)[.](?:com|org|net|edu|gov|info|io|de|fr|es|uk|it|eu)$'", "false"),
    "ip": ("not c.found rlike '^(?:0|127|22[4-9]|2[3-5][0-9])[.]'", "c.found rlike '^(?:0|127|22[4-9]|2[3-5][0-9])[.]'"),
    "card": ("c.found rlike '^(?:4|5[1-5]|2[2-7]|3[47]|6)'", "c.found rlike '^0'"),
    "phone": ("c.found rlike '^[+](?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])'", "c.found rlike '^[+]0'"),
    "local_phone": ("false", "c.found rlike '^[(]?555'"),
    "national_id": ("false", "c.found rlike '^123-45-6789$'"),
    "iban": ("c.found rlike '^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)'",
             "not c.found rlike '^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)'"),
    "masked_email": ("c.found rlike '(?i)(?:com|org|net|edu|gov|de|fr|es)$'", "false"),
    "name": ("c.found rlike ' (?:John|Mary|James|Anna|Peter|Maria|Paul|Laura|David|Sarah|Thomas|Julia|Michael|"
             "Emma|Robert|Marie|Jean|Pierre|Hans|Klaus|Carlos|Jose|Luis|Carmen)(?: |$)'", "false"),
}
CONTEXT = {
    "email": ("concat(c.b, c.a) rlike 'mail|contact|write|reach'", "false"),
    "ip": ("concat(c.b, c.a) rlike '\\\\bip\\\\b|host|server|address|login'", "c.b rlike 'version|release|section|v[. ]*$'"),
    "card": ("concat(c.b, c.a) rlike 'card|visa|mastercard|credit|payment'", "c.b rlike 'isbn|order|serial|part'"),
    "phone": ("concat(c.b, c.a) rlike 'phone|call|tel|mobile|fax|contact'", "false"),
    "local_phone": ("concat(c.b, c.a) rlike 'phone|call|tel|mobile|fax|contact'", "c.b rlike 'order|invoice|part|serial|isbn'"),
    "national_id": ("concat(c.b, c.a) rlike 'ssn|social security|national id|tax id'", "c.b rlike 'order|invoice|part|serial|isbn'"),
    "iban": ("concat(c.b, c.a) rlike 'iban|account|bank|transfer'", "c.b rlike 'order|part|serial|model'"),
    "masked_email": ("concat(c.b, c.a) rlike 'mail|contact|write|reach'", "false"),
    "name": ("concat(c.b, c.a) rlike 'name|contact|dear|born|signed|call'", "false"),
}
LABELERS = [FORMAT, GAZETTEER, CONTEXT]
FEATURES = ("v0", "v1", "v2", "left", "right", "size")
CAND = "struct<start:int,rank:int,kind:string,end:int,found:string," \
       "v0:string,v1:string,v2:string,left:string,right:string,size:string>"


def _voted(labeler: dict) -> str:
    """A labeler's vote on a span `c`, as '1', '0' or '-1'."""
    whens = " ".join(f"when {quoted(k)} then case when {yes} then '1' when {no} then '-1' else '0' end"
                     for k, (yes, no) in labeler.items())
    return f"case c.kind {whens} end"


def _with_context(text: str) -> Column:
    return F.expr(f"""transform(_spans, c -> named_struct(
        'start', c.start, 'rank', c.rank, 'kind', c.kind, 'end', c.end, 'found', c.found,
        'b', lower(substr({text}, greatest(c.start - 39, 1), least(c.start, 40))),
        'a', lower(substr({text}, c.end + 1, 20))))""")


def add_candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """docs with a column `out`: the candidate spans of its column `text` (no nulls) with votes."""
    found = [F.when(F.expr(NEEDS[k].format(text)), regex_spans(text, r, k, i, keep)).otherwise(no_spans())
             for i, (k, r, keep) in enumerate(KINDS)]
    base, more = F.concat(*found[:len(BASE_KINDS)]), F.concat(*found[len(BASE_KINDS):])
    free = clear_of("_more", "_base")
    votes = ", ".join(f"'v{i}', {_voted(lab)}" for i, lab in enumerate(LABELERS))
    around = "case when {0} = '' then 'edge' when {0} rlike '[a-z]' then 'letter' " \
             "when {0} rlike '[0-9]' then 'digit' when {0} rlike '\\\\s' then 'space' else 'mark' end"
    return (docs.withColumn("_base", base).withColumn("_more", more)
            .withColumn("_spans", F.concat("_base", free))
            .withColumn("_seen", _with_context(text))
            .withColumn(out, F.expr(f"""array_sort(transform(_seen, c -> named_struct(
                'start', c.start, 'rank', c.rank, 'kind', c.kind, 'end', c.end, 'found', c.found,
                {votes},
                'left', {around.format("right(c.b, 1)")}, 'right', {around.format("substr(c.a, 1, 1)")},
                'size', cast(least(length(c.found) div 4, 8) as string))))"""))
            .drop("_base", "_more", "_spans", "_seen"))


def em(patterns: list[tuple[str, tuple[str, ...], int]], rounds: int = 50) -> dict:
    """Soft labels {(kind, votes): probability} from counts of vote patterns, by two-class
    expectation-maximisation. A labeler's chance of each vote, given the class, is shared by all kinds;
    each kind has its own share of true spans. Pseudo-counts state that labelers are right more often than not."""
    n_lab = len(LABELERS)
    start = {1: {"1": 6.0, "0": 3.0, "-1": 1.0}, 0: {"1": 1.0, "0": 3.0, "-1": 6.0}}
    share = {k: 0.5 for k, _, _ in patterns}
    table = {y: [{v: c / 10 for v, c in start[y].items()} for _ in range(n_lab)] for y in (0, 1)}
    soft: dict = {}
    for _ in range(rounds):
        for kind, votes, _n in patterns:
            p1, p0 = share[kind], 1 - share[kind]
            for i, v in enumerate(votes):
                p1 *= table[1][i][v]
                p0 *= table[0][i][v]
            soft[kind, votes] = p1 / (p1 + p0)
        heads: dict = {k: [1.0, 2.0] for k in share}  # one true and one false span of each kind
        sums = {y: [dict(start[y]) for _ in range(n_lab)] for y in (0, 1)}
        for kind, votes, n in patterns:
            p = soft[kind, votes]
            heads[kind][0] += n * p
            heads[kind][1] += n
            for i, v in enumerate(votes):
                sums[1][i][v] += n * p
                sums[0][i][v] += n * (1 - p)
        share = {k: a / b for k, (a, b) in heads.items()}
        table = {y: [{v: c / sum(d.values()) for v, c in d.items()} for d in sums[y]] for y in (0, 1)}
    return soft


def fit(spans: DataFrame, col: str) -> dict:
    """Train on a frame with a column of candidate arrays. The model is {'bias': {kind: log odds},
    'weight': {'kind|feature|value': log ratio}}."""
    flat = spans.select(F.explode(col).alias("c")).select("c.kind", *[f"c.{f}" for f in FEATURES])
    votes = list(FEATURES[:len(LABELERS)])
    counts = flat.groupBy("kind", *votes).count().orderBy("kind", *votes).collect()  # bounded by kinds x 27
    soft = em([(r["kind"], tuple(r[v] for v in votes), r["count"]) for r in counts])
    label = "0.5D"
    if soft:
        label = "case " + " ".join("when " + " and ".join(
            f"{name} = {quoted(v)}" for name, v in zip(["kind", *votes], [k, *vs])) + f" then {p!r}D"
            for (k, vs), p in soft.items()) + " end"
    pairs = ", ".join(f"named_struct('f', '{f}', 'v', {f})" for f in FEATURES)
    sums = (flat.withColumn("p", F.expr(label)).select("kind", "p", F.expr(f"inline(array({pairs}))"))
            .groupBy("kind", "f", "v").agg(F.sum("p").alias("p"), F.count("*").alias("n")).collect())
    total = {}
    for r in sums:
        if r["f"] == FEATURES[0]:
            p, n = total.get(r["kind"], (0.0, 0))
            total[r["kind"]] = (p + r["p"], n + r["n"])
    bias = {k: math.log((p + 1) / (n - p + 1)) for k, (p, n) in total.items()}
    weight = {}
    for r in sums:
        p, n = total[r["kind"]]
        weight[f"{r['kind']}|{r['f']}|{r['v']}"] = round(
            math.log((r["p"] + 1) / (p + 4)) - math.log((r["n"] - r["p"] + 1) / (n - p + 4)), 9)
    return {"bias": bias, "weight": weight}


def classify(col: str, model: dict, threshold: float) -> Column:
    """The accepted spans of a column of candidates: all base kinds, and further ones that some
    labeler backs and whose class probability reaches the threshold."""
    base = ", ".join(quoted(k) for k, *_ in BASE_KINDS)
    if not model["bias"]:
        return F.expr(f"filter({col}, c -> c.kind in ({base}))")
    pairs = lambda d: "map(" + ", ".join(f"{quoted(k)}, {v!r}D" for k, v in sorted(d.items())) + ")"
    odds = f"try_element_at({pairs(model['bias'])}, c.kind)" + "".join(
        f" + coalesce(try_element_at({pairs(model['weight'])}, concat(c.kind, '|{f}|', c.{f})), 0D)"
        for f in FEATURES)
    cut = math.log(threshold / (1 - threshold))
    return F.expr(f"""filter({col}, c -> c.kind in ({base}) or
        (c.v0 = '1' and (c.v1 = '1' or c.v2 = '1') and {odds} >= {cut!r}D))""")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.9, keep_rows: bool = False) -> DataFrame:
    """doc_id and spans (array of `CAND` structs) for every row; with `keep_rows` also `row`, the
    whole input row as a struct. The candidates are written once to the shared scratch folder,
    so that training and classification do not search the texts again."""
    cols = [F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")]
    if keep_rows:
        cols.append(F.struct("*").alias("row"))
    seen = add_candidates(docs.select(*cols), "_text", "_cands").drop("_text")
    seen = write_through(seen, "pii-candidates")
    model = fit(seen, "_cands")
    return seen.select("doc_id", *["row"] * keep_rows, classify("_cands", model, threshold).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; a span that overlaps an earlier
    one is merged into it."""
    step = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["start"] >= a["at"], F.struct(
            s["end"].alias("at"),
            F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                     F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out")))
        .otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(step["out"], F.substring(text, step["at"] + 1, F.length(text))))
