"""Registered queries for distribution chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..columns import round_all
from ..operators import distribution as d
from .q_profile import LINE_COLS, _pairs_sql, _skew, _kurt
from .registry import make_registry
from .tables import table

Q, q = make_registry()


def _bin_sql(x: str, lo: str, hi: str, bins: int) -> str:
    step = f"(({hi} - {lo}) / {bins})"
    guess = (f"(CASE WHEN {hi} = {lo} THEN 0 ELSE CAST(least(floor(({x} - {lo}) / {step}), "
             f"{bins - 1}) AS INTEGER) END)")

    def edge(i):
        return f"(CASE WHEN {i} = {bins} THEN {hi} ELSE {lo} + {i} * {step} END)"

    down = f"(CASE WHEN {guess} > 0 AND {x} < {edge(guess)} THEN {guess} - 1 ELSE {guess} END)"
    return (f"(CASE WHEN {down} < {bins - 1} AND {x} >= {edge(f'({down} + 1)')} "
            f"THEN {down} + 1 ELSE {down} END)")


def _hist_sql(src: str, bins: int, by: str | None = None, shared: bool = True,
              density: bool = False, center: bool = False) -> str:
    """src yields columns (g?, x) with x not null."""
    g = f"{by}, " if by else ""
    bkeys = f"{by}, " if (by and not shared) else ""
    bounds = f"SELECT {bkeys}min(x) AS lo, max(x) AS hi, count(x) AS n FROM ({src}) s" + (
        f" GROUP BY {by}" if (by and not shared) else "")
    join_b = f"JOIN b USING ({by})" if (by and not shared) else "CROSS JOIN b"
    counts = (f"SELECT {g}{_bin_sql('x', 'lo', 'hi', bins)} AS bin, count(*) AS c "
              f"FROM ({src}) v {join_b} GROUP BY ALL")
    frame = (f"SELECT {g}CAST(r.range AS INTEGER) AS bin, lo, hi, n FROM range({bins}) r"
             + (f" CROSS JOIN (SELECT DISTINCT {by} FROM ({src}) s2) gg" if by else "")
             + (f" JOIN b USING ({by})" if (by and not shared) else " CROSS JOIN b"))
    step = f"((hi - lo) / {bins})"
    dens = (f", round(coalesce(c, 0) / (n * ((CASE WHEN bin = {bins - 1} THEN hi ELSE lo + (bin + 1) "
            f"* {step} END) - (lo + bin * {step}))), 9) AS density") if density else ""
    using = f"USING ({by}, bin)" if by else "USING (bin)"
    if center:
        where = f" WHERE c.{by} = fr.{by}" if (by and not shared) else ""
        dens += "".join(f", round((SELECT {fn} FROM ({src}) c{where}), 6) AS {name}" for fn, name in (
            ("avg(c.x)", "mean"), ("quantile_cont(c.x, 0.5)", "median")))
    return (f"WITH b AS ({bounds}), cnt AS ({counts}), fr AS ({frame}) "
            f"SELECT {g}bin, round(lo + bin * {step}, 6) AS bin_left, round(CASE WHEN bin = "
            f"{bins - 1} THEN hi ELSE lo + (bin + 1) * {step} END, 6) AS bin_right, "
            f"CAST(coalesce(c, 0) AS BIGINT) AS n{dens} FROM fr LEFT JOIN cnt {using}")


_PRICE = "SELECT l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL"
_EVENTS = "SELECT value AS x FROM events WHERE value IS NOT NULL AND NOT isnan(value)"


def _bins_sql(src: str) -> str:
    st = (f"SELECT count(x) AS n, min(x) AS mn, max(x) AS mx, quantile_cont(x, 0.25) AS q25, "
          f"quantile_cont(x, 0.75) AS q75 FROM ({src}) s")
    sturges = "CAST(ceil(log2(n) + 1) AS BIGINT)"
    fd = (f"CASE WHEN q75 - q25 > 0 THEN CAST(floor((mx - mn) / (2 * (q75 - q25) * "
          f"pow(n, -1.0 / 3.0))) AS BIGINT) ELSE {sturges} END")
    rules = {"sturges": sturges, "sqrt": "CAST(floor(sqrt(n)) AS BIGINT)",
             "rice": "CAST(floor(2 * pow(n, 1.0 / 3.0)) AS BIGINT)", "fd": fd,
             "auto": f"greatest({sturges}, {fd})"}
    return " UNION ALL ".join(f"SELECT '{m}' AS method, {e} AS bins FROM ({st}) t"
                              for m, e in rules.items())


@q("bin_counts", _bins_sql(_PRICE))
def _bin_counts(spark, sf):
    return d.bin_counts(table(spark, sf, "lineitem"), "l_extendedprice")


@q("histogram", _hist_sql(_PRICE, 20, center=True))
def _histogram(spark, sf):
    return round_all(d.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 20, center=True))


@q("histogram_by_group", _hist_sql(
    "SELECT l_returnflag, l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL",
    10, "l_returnflag"))
def _histogram_by_group(spark, sf):
    return round_all(d.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 10,
                                 by=["l_returnflag"]))


@q("histogram_dual", _hist_sql(
    "SELECT l_linestatus, l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL",
    15, "l_linestatus", shared=False, center=True))
def _histogram_dual(spark, sf):
    return round_all(d.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 15,
                                 by=["l_linestatus"], shared_edges=False, center=True))


@q("histogram_density", _hist_sql(_EVENTS, 30, density=True, center=True))
def _histogram_density(spark, sf):
    out = d.histogram(table(spark, sf, "events"), "value", 30, density=True, center=True)
    return round_all(out, skip=["density"]).withColumn("density", F.round("density", 9))


_EDGES = d.arange_edges(0, 100000, 5000)


def _edges_sql():
    e = _EDGES
    vals = ", ".join(f"({i}, {e[i]}, {e[i + 1]})" for i in range(len(e) - 1))
    return (f"SELECT g.bin, CAST(g.l AS DOUBLE) AS bin_left, CAST(g.r AS DOUBLE) AS bin_right, "
            f"CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM (VALUES {vals}) g(bin, l, r) LEFT JOIN "
            f"(SELECT CASE WHEN x = {e[-1]} THEN {len(e) - 2} ELSE "
            f"CAST(floor((x - {e[0]}) / {e[1] - e[0]}) AS INTEGER) END AS bin, count(*) AS n FROM "
            f"({_PRICE}) s WHERE x >= {e[0]} AND x <= {e[-1]} GROUP BY 1) c ON g.bin = c.bin")


@q("histogram_edges", _edges_sql())
def _histogram_edges(spark, sf):
    return d.histogram_edges(table(spark, sf, "lineitem"), "l_extendedprice", _EDGES)


@q("kde_curve",
   "WITH s AS (SELECT count(x) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM "
   f"({_EVENTS}) e), g AS (SELECT CAST(range AS INTEGER) AS i, CASE WHEN range = 499 THEN mx ELSE "
   "mn + range * ((mx - mn) / 499) END AS x FROM range(500), s), w AS (SELECT x AS v, count(*) AS c "
   f"FROM ({_EVENTS}) e GROUP BY x) SELECT g.i, round(g.x, 6) AS x, round(sum(w.c * exp(-0.5 * "
   "((g.x - w.v) / (s.sd * pow(s.n, -0.2))) * ((g.x - w.v) / (s.sd * pow(s.n, -0.2))))) / (s.n * "
   "(s.sd * pow(s.n, -0.2)) * sqrt(2 * pi())), 12) AS density FROM g, w, s GROUP BY g.i, g.x, s.n, s.sd")
def _kde_curve(spark, sf):
    out = d.kde_curve(table(spark, sf, "events"), "value", 500)
    return out.select("i", F.round("x", 6).alias("x"), F.round("density", 12).alias("density"))


@q("ecdf", f"SELECT x AS value, CAST(sum(c) OVER (ORDER BY x) AS BIGINT) AS n_le, round(sum(c) "
           f"OVER (ORDER BY x) / sum(c) OVER (), 12) AS ecdf FROM (SELECT x, count(*) AS c FROM "
           f"({_EVENTS}) e GROUP BY x) t")
def _ecdf(spark, sf):
    out = d.ecdf(table(spark, sf, "events"), "value")
    return out.withColumn("ecdf", F.round("ecdf", 12))


@q("ecdf_markers", f"SELECT round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) "
                   f"AS q2, round(quantile_cont(x, 0.75), 6) AS q3, round(avg(CASE WHEN x <= 50.0 "
                   f"THEN 1.0 ELSE 0.0 END), 6) AS share_le, 50.0 AS threshold FROM ({_EVENTS}) e")
def _ecdf_markers(spark, sf):
    return round_all(d.ecdf_markers(table(spark, sf, "events"), "value", 50.0))


def _dispersion_sql(src: str) -> str:
    fd = [r for r in _bins_sql(src).split(" UNION ALL ") if "'fd'" in r][0]
    fd = fd.replace("'fd' AS method, ", "")
    m = (f"SELECT CAST(count(x) AS BIGINT) AS n, avg(x) AS mean, quantile_cont(x, 0.5) AS median, "
         f"stddev_samp(x) AS std, {_skew('x')} AS skew, {_kurt('x')} AS kurt FROM ({src}) s")
    r6 = lambda e: f"round({e}, 6)"
    cols = ["n", f"({fd}) AS bins", r6("mean") + " AS mean", r6("median") + " AS median",
            r6("std") + " AS std", r6("skew") + " AS skew", r6("kurt") + " AS kurt"]
    cols += [r6(f"mean - {k} * std") + f" AS lower_{k}s" for k in (1, 2, 3)]
    cols += [r6(f"mean + {k} * std") + f" AS upper_{k}s" for k in (1, 2, 3)]
    cols += [f"(SELECT CAST(count(*) AS BIGINT) FROM ({src}) o WHERE abs(o.x - m.mean) > 3 * m.std) "
             f"AS n_outliers_3s", "abs(skew) < 0.5 AND abs(kurt) < 1 AS approx_normal",
             "n <= 5000 AS small_sample"]
    return f"SELECT {', '.join(cols)} FROM ({m}) m"


_ACCT = "SELECT c_acctbal AS x FROM customer WHERE c_acctbal IS NOT NULL"


@q("dispersion_small", _dispersion_sql(_ACCT))
def _dispersion_small(spark, sf):
    out = d.dispersion_summary(table(spark, sf, "customer"), "c_acctbal", shapiro=True)
    return round_all(out.drop("shapiro_p"))  # p is checked in pytest against published values


@q("dispersion_large", _dispersion_sql(_EVENTS))
def _dispersion_large(spark, sf):
    return round_all(d.dispersion_summary(table(spark, sf, "events"), "value"))


@q("rug_points", f"SELECT x AS value, CAST(count(*) AS BIGINT) AS n FROM ({_EVENTS}) e GROUP BY x")
def _rug_points(spark, sf):
    return d.rug_points(table(spark, sf, "events"), "value")


@q("scatter_bins",
   "WITH v AS (SELECT l_returnflag, CAST(l_quantity AS DOUBLE) AS x, l_extendedprice AS y FROM "
   "lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL), b AS (SELECT min(x) AS "
   "xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM v) SELECT "
   f"{_bin_sql('x', 'xl', 'xh', 20)} AS bin_x, {_bin_sql('y', 'yl', 'yh', 20)} AS bin_y, l_returnflag, "
   "CAST(count(*) AS BIGINT) AS n FROM v, b GROUP BY ALL")
def _scatter_bins(spark, sf):
    return d.scatter_bins(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice",
                          "l_returnflag", 20)


@q("scatter_points", "SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y, l_returnflag FROM "
                     "lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL")
def _scatter_points(spark, sf):
    return d.scatter_points(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag")


def _pair_bins_sql(both: bool = False):
    cols = LINE_COLS
    b = ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(cols))
    parts = []
    for i, cy in enumerate(cols):
        for k, cx in enumerate(cols):
            if i > k or (both and i != k):
                parts.append(
                    f"SELECT '{cx}' AS x_col, '{cy}' AS y_col, "
                    f"{_bin_sql(f'CAST({cx} AS DOUBLE)', f'lo{k}', f'hi{k}', 10)} AS bin_x, "
                    f"{_bin_sql(f'CAST({cy} AS DOUBLE)', f'lo{i}', f'hi{i}', 10)} AS bin_y "
                    f"FROM lineitem, b WHERE {cx} IS NOT NULL AND {cy} IS NOT NULL")
    return (f"WITH b AS (SELECT {b} FROM lineitem) SELECT x_col, y_col, bin_x, bin_y, "
            f"CAST(count(*) AS BIGINT) AS n FROM ({' UNION ALL '.join(parts)}) u GROUP BY ALL")


@q("pair_bins", _pair_bins_sql())
def _pair_bins(spark, sf):
    return d.pair_bins(table(spark, sf, "lineitem"), LINE_COLS, 10)


@q("pair_correlation", "SELECT x, y, r FROM (" + _pairs_sql("lineitem", LINE_COLS, False, "r")
   + ") t")
def _pair_correlation(spark, sf):
    return round_all(d.pair_correlation(table(spark, sf, "lineitem"), LINE_COLS))


@q("pairplot_bins", _pair_bins_sql(both=True))
def _pairplot_bins(spark, sf):
    return d.pair_bins(table(spark, sf, "lineitem"), LINE_COLS, 10, both_triangles=True)


@q("kde_counts",
   "WITH s AS (SELECT count(x) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM "
   f"({_PRICE}) e), g AS (SELECT CAST(range AS INTEGER) AS i, CASE WHEN range = 399 THEN mx ELSE "
   "mn + range * ((mx - mn) / 399) END AS x FROM range(400), s), w AS (SELECT x AS v, count(*) AS c "
   f"FROM ({_PRICE}) e GROUP BY x) SELECT g.i, round(g.x, 6) AS x, round(sum(w.c * exp(-0.5 * "
   "((g.x - w.v) / (s.sd * pow(s.n, -0.2))) * ((g.x - w.v) / (s.sd * pow(s.n, -0.2))))) / (s.n * "
   "(s.sd * pow(s.n, -0.2)) * sqrt(2 * pi())) * s.n * ((s.mx - s.mn) / 20), 4) AS density "
   "FROM g, w, s GROUP BY g.i, g.x, s.n, s.sd, s.mx, s.mn")
def _kde_counts(spark, sf):
    """H12 diagonal: KDE on 400 points within the histogram edges, scaled to counts
    (n x bin width of a 20-bin histogram)."""
    li = table(spark, sf, "lineitem")
    st = li.agg(F.min("l_extendedprice").alias("mn"), F.max("l_extendedprice").alias("mx")).first()
    width = (st["mx"] - st["mn"]) / 20
    out = d.kde_curve(li, "l_extendedprice", 400, scale_counts_width=width)
    return out.select("i", F.round("x", 6).alias("x"), F.round("density", 4).alias("density"))
