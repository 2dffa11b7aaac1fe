"""Tables that later runs go on from: category codes (C19) and lookups."""

import pytest

from scrubstat.operators import kept
from scrubstat.operators.convert import category_codes
from scrubstat.operators.enrich import enrich_lookup
from scrubstat.plans.tables import table
from scrubstat.session import write_through


def codes_of(df):
    return {(r["column_name"], r["value"]): r["code"] for r in df.collect()}


def test_codes_of_many_columns_from_one_ranking(spark):
    cols = [f"c{i}" for i in range(10)]
    df = spark.createDataFrame([[f"v{(i * (k + 3)) % 17}" if (i + k) % 5 else None for k in range(10)] for i in range(60)], cols)
    codes = write_through(kept.category_table(df, cols), "test-codes")
    out = kept.encode(df, cols, codes)
    assert out.columns == [*cols, *[f"{c}_code" for c in cols]]
    rows = sorted(map(repr, ([r[c] for c in cols] + [r[f"{c}_code"] for c in cols] for r in out.collect())))
    single = df
    for c in cols:
        single = category_codes(single, c)
    assert rows == sorted(map(repr, ([r[c] for c in cols] + [r[f"{c}_code"] for c in cols] for r in single.collect())))


def test_codes_stay_over_runs(spark, tmp_path):
    folder = str(tmp_path / "codes")
    first = spark.createDataFrame([("b", "x"), ("d", None), ("b", "y")], "p string, q string")
    one = codes_of(kept.extend_codes(first, ["p", "q"], folder))
    assert one == {("p", "b"): 0, ("p", "d"): 1, ("q", "x"): 0, ("q", "y"): 1}
    assert codes_of(kept.extend_codes(first, ["p", "q"], folder)) == one
    later = spark.createDataFrame([("a", "x"), ("c", "z"), ("d", "w")], "p string, q string")
    two = codes_of(kept.extend_codes(later, ["p", "q"], folder))
    assert two == {**one, ("p", "a"): 2, ("p", "c"): 3, ("q", "w"): 2, ("q", "z"): 3}
    coded = kept.encode(later.union(spark.createDataFrame([(None, "new")], "p string, q string")), ["p", "q"], kept.read_kept(spark, folder, kept.CODES))
    assert sorted(tuple(r)[2:] for r in coded.collect()) == [(-1, -1), (1, 2), (2, 0), (3, 3)]
    assert codes_of(kept.extend_codes(first.limit(0), ["p", "q"], folder)) == two


def test_lookups_are_made_once(spark, sf, tmp_path, monkeypatch):
    folder = str(tmp_path / "lookups")
    part, pages = table(spark, sf, "part").limit(60), table(spark, sf, "pages")
    part = write_through(part, "some-parts")
    asked = []
    real = kept.lookup_years

    def counted(keys, *args, **options):
        asked.append(keys.count())
        return real(keys, *args, **options)

    monkeypatch.setattr(kept, "lookup_years", counted)
    half = part.where("p_partkey % 2 = 0")
    n_half, n_all = (d.select("p_name", "p_brand").distinct().count() for d in (half, part))
    kept.enrich_kept(half, "p_name", "p_brand", pages, folder)
    out = kept.enrich_kept(part, "p_name", "p_brand", pages, folder)
    again = kept.enrich_kept(part, "p_name", "p_brand", pages, folder)
    assert asked == [n_half, n_all - n_half]
    want = sorted(map(repr, enrich_lookup(part, "p_name", "p_brand", pages).collect()))
    assert sorted(map(repr, out.collect())) == want and sorted(map(repr, again.collect())) == want


@pytest.mark.parametrize("most", [1, 100])
def test_compaction_keeps_all_rows(spark, tmp_path, most):
    folder = str(tmp_path / "t")
    for i in range(4):
        rows = spark.createDataFrame([("c", f"v{i}{k}", k) for k in range(3)], kept.CODES)
        whole = kept.append_kept(rows, folder, kept.CODES, most_files=most)
        assert whole.count() == 3 * (i + 1)
    assert len(list((tmp_path / "t").iterdir())) == 1 and (kept.newest(spark, folder) > 1) == (most == 1)
