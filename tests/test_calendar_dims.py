import datetime as dt

from pyspark.sql import functions as F

from dimstar.functions import calendar as cal
from dimstar.operators import dims

D = dt.date


def table(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_fiscal_boundaries(spark):
    days = [D(2023, 7, 31), D(2023, 8, 1), D(2023, 10, 31), D(2023, 11, 1), D(2024, 1, 31), D(2024, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    found = table(
        df.select(
            "d", cal.fiscal_year(d), cal.fiscal_quarter(d), cal.fiscal_quarter_start(d),
            cal.fiscal_quarter_name(d), cal.fiscal_period_name(d),
            cal.quarter_key(cal.fiscal_year(d), cal.fiscal_quarter(d)),
        ),
        "d",
    )
    assert [r[1:6] for r in found] == [
        (2023, 4, D(2023, 5, 1), "FQ4 2023", "FY2023 Q4"),
        (2024, 1, D(2023, 8, 1), "FQ1 2024", "FY2024 Q1"),
        (2024, 1, D(2023, 8, 1), "FQ1 2024", "FY2024 Q1"),
        (2024, 2, D(2023, 11, 1), "FQ2 2024", "FY2024 Q2"),
        (2024, 2, D(2023, 11, 1), "FQ2 2024", "FY2024 Q2"),
        (2024, 3, D(2024, 2, 1), "FQ3 2024", "FY2024 Q3"),
    ]
    assert all(r[6] == r[3] for r in found)


def test_calendar_year_as_fiscal_year(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 12, 31),)], "d date")
    d = F.col("d")
    found = table(df.select(cal.fiscal_year(d, 1), cal.fiscal_quarter(d, 1), cal.fiscal_quarter_start(d, 1)), F.lit(1))
    assert sorted(found) == [(2024, 1, D(2024, 1, 1)), (2024, 4, D(2024, 10, 1))]


def test_week_ends_on_sunday(spark):
    df = spark.createDataFrame([(D(2024, 3, 3),), (D(2024, 3, 4),), (D(2024, 3, 9),)], "d date")
    found = table(df.select("d", cal.week_end(F.col("d"))), "d")
    assert [r[1] for r in found] == [D(2024, 3, 3), D(2024, 3, 10), D(2024, 3, 10)]


def test_date_dim(spark):
    rows = {r["date_key"]: r for r in dims.date_dim(spark, D(2022, 1, 1), D(2024, 12, 31)).collect()}
    assert len(rows) == 1096
    sunday = rows[D(2024, 3, 3)]
    assert (sunday["day_of_week_num"], sunday["day_of_week_name"]) == (1, "Sunday")
    assert sunday["is_weekend"] and not sunday["is_holiday"] and sunday["week_number"] == 9
    assert rows[D(2023, 11, 23)]["holiday_name"] == "Thanksgiving"
    assert rows[D(2024, 11, 28)]["holiday_name"] == "Thanksgiving"
    assert sum(r["is_holiday"] for r in rows.values()) == 12


def test_month_dim(spark):
    rows = table(dims.month_dim(spark, D(2022, 1, 15), D(2024, 12, 31)), "month_key")
    assert len(rows) == 36
    assert rows[0] == (D(2022, 1, 1), "January", 1, 1, 2022, 2, 2022, "FY2022 Q2")


def test_junk_dims(spark):
    domains = {"a": ["x", "y"], "b": ["p", "q", "r"]}
    found = table(dims.junk_dim_from_domains(spark, domains, "k"), "k")
    assert found == [
        (1, "x", "p"), (2, "x", "q"), (3, "x", "r"), (4, "y", "p"), (5, "y", "q"), (6, "y", "r"),
    ]
    seen = spark.createDataFrame([("y", "p"), ("x", "q"), ("y", "p")], "a string, b string")
    assert table(dims.junk_dim(seen, ["a", "b"], "k"), "k") == [(1, "x", "q"), (2, "y", "p")]


def test_surrogate_key_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("n"))
    keyed = dims.surrogate_key(df, ["n"], "k", start=5, ranges=7)
    assert keyed.filter("k <> n + 4").count() == 0 and keyed.count() == 1000


def test_hierarchy_shrink_and_role(spark):
    leaf = spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "t int, d int")
    mid = spark.createDataFrame([(10, 100, "D10"), (20, 200, "D20")], "d int, r int, dname string")
    top = spark.createDataFrame([(100, "R1"), (200, "R2")], "r int, rname string")
    flat = dims.flatten_hierarchy(leaf, [(mid, "d", "d"), (top, "r", "r")])
    assert {(r["t"], r["dname"], r["rname"]) for r in flat.collect()} == {
        (1, "D10", "R1"), (2, "D10", "R1"), (3, "D20", "R2"),
    }
    assert dims.shrink_dim(flat, ["dname", "rname"]).count() == 2
    assert dims.role_play(top, "x_").columns == ["x_r", "x_rname"]


def test_text_split(spark):
    df = spark.createDataFrame([(7, "abc", "note", 1.5)], "id bigint, txt string, kind string, m double")
    fact, notes = dims.split_text_dim(df, "id", "txt", "call_notes_key", ["kind"])
    assert fact.columns == ["id", "m", "call_notes_key"]
    assert table(notes, "call_notes_key") == [(7, "abc", 3, "note")]


def test_decile_directions(spark):
    fact = spark.range(20).select(F.col("id").alias("e"), (F.col("id") * 2).alias("m"))
    first = {r["e"]: r["band"] for r in dims.band_decile(fact, "e", "m").collect()}
    last = {r["e"]: r["band"] for r in dims.band_decile(fact, "e", "m", direction="highest_last").collect()}
    assert first[19] == 1 and first[0] == 10 and last[19] == 10 and last[0] == 1


def test_segment_bands(spark):
    df = spark.createDataFrame([(250,), (200,), (199,), (0,)], "v int")
    tier = dims.band_segment(F.col("v"), [("A", 200), ("B", 100)], "C")
    assert sorted(r[0] for r in df.select(tier).collect()) == ["A", "A", "B", "C"]


def test_key_registry_keeps_keys_across_loads(spark, tmp_path):
    from dimstar.operators.dims import registered_keys

    registry = str(tmp_path / "keys")
    first = spark.createDataFrame([("b", 1), ("d", 2), ("a", 3), ("a", 4), (None, 5)], "code string, v int")
    one = {(r.code, r.v): r.k for r in registered_keys(first, registry, ["code"], "k").collect()}
    # NULL sorts as the largest value
    assert one == {("a", 3): 1, ("a", 4): 1, ("b", 1): 2, ("d", 2): 3, (None, 5): 4}
    # a later load with new and late natural keys (c sorts between earlier ones)
    second = spark.createDataFrame([("c", 6), ("a", 7), ("e", 8), (None, 9)], "code string, v int")
    two = {(r.code, r.v): r.k for r in registered_keys(second, registry, ["code"], "k").collect()}
    assert two == {("a", 7): 1, (None, 9): 4, ("c", 6): 5, ("e", 8): 6}
    stored = spark.read.parquet(registry)
    assert sorted(r.k for r in stored.collect()) == [1, 2, 3, 4, 5, 6]  # dense, no key twice
    assert stored.groupBy("code").count().where("count > 1").count() == 0
    # a repeated load changes nothing
    registered_keys(second, registry, ["code"], "k").count()
    assert spark.read.parquet(registry).count() == 6
