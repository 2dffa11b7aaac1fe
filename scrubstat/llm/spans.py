"""Regex spans as Catalyst expressions (shared by the personal-data and secret operators).

A span is struct(start int, rank int, kind string, end int, found string): code point offsets,
end exclusive; arrays of spans sort by start, then by the rank of the kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,rank:int,kind:string,end:int,found:string>"


def no_spans() -> Column:
    return F.expr(f"cast(array() as array<{SPAN}>)")


def quoted(s: str) -> str:
    """A Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bound(name: str, value: str, body: str) -> str:
    """SQL for `body` with `name` standing for the array or struct `value`, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def running(values: str, op: str, least: str) -> str:
    """SQL for the running `op` (of x and y) over an array, `least` being neutral. Each step combines values twice as far
    apart, so n values take n log n work; appending to an array instead would take n squared."""
    step = f"transform(a, (y, i) -> {op.format('y', f'if(i >= shiftleft(1, k), a[greatest(0, i - shiftleft(1, k))], {least})')})"
    return bound("w", values, f"if(size(w) < 2, w, aggregate(sequence(0, cast(ceil(log2(size(w))) as int)), w, (a, k) -> {step}))")


def regex_spans(text: str, regex: str, kind: str, rank: int, keep: str = "true",
                groups: bool = False) -> Column:
    """Leftmost non-overlapping matches of `regex` in the column `text`; those for which the SQL
    condition `keep` over `x.m` (and `x.v`, group 2, with `groups`) fails are dropped without a
    retry. One pass extracts the matches, one the gaps between them; running sums of their lengths are
    the offsets."""
    r = quoted(regex)
    value = f"regexp_extract_all({text}, {r}, 2)" if groups else "s.m"
    ends = running("zip_with(slice(s.g, 1, size(s.m)), s.m, (g, m) -> g + length(m))", "{} + {}", "0")
    spans = f"""transform(filter(
        zip_with(zip_with({ends}, s.m, (e, m) -> named_struct('e', e, 'm', m)), {value},
                 (p, v) -> named_struct('e', p.e, 'm', p.m, 'v', v)), x -> {keep}),
        x -> named_struct('start', x.e - length(x.m), 'rank', {rank}, 'kind', {quoted(kind)}, 'end', x.e, 'found', x.m))"""
    found = f"named_struct('g', transform(split({text}, {r}, -1), x -> length(x)), 'm', regexp_extract_all({text}, {r}, 0))"
    return F.expr(f"cast({bound('s', found, spans)} as array<{SPAN}>)")


def clear_of(more: str, base: str) -> Column:
    """The spans of the column `more` that overlap none of the column `base`."""
    ends = running("transform(t, x -> if(x.b, x.s.end, -1))", "greatest({}, {})", "-1")
    starts = running("reverse(transform(t, x -> if(x.b, x.s.start, 2147483647)))", "least({}, {})", "2147483647")
    both = f"""array_sort(concat(transform({base}, s -> named_struct('at', s.start, 'b', true, 's', s)),
        transform({more}, s -> named_struct('at', s.start, 'b', false, 's', s))))"""
    free = """transform(filter(transform(t, (x, i) -> named_struct('x', x, 'e', u.e[i], 'f', u.f[size(t) - 1 - i])),
        y -> not y.x.b and y.e <= y.x.s.start and y.f >= y.x.s.end), y -> y.x.s)"""
    body = bound("t", both, bound("u", f"named_struct('e', {ends}, 'f', {starts})", free))
    return F.expr(f"if(size({more}) = 0 or size({base}) = 0, {more}, cast({body} as array<{SPAN}>))")


def spans_text(spans: Column) -> Column:
    """`kind:start:end` by start, then kind rank, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
