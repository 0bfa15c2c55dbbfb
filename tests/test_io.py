import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimstar.operators import quality
from dimstar.plans import load
from dimstar.sources import io, schema
from dimstar.sources.adapter import SalesStar
from tests.bag import rows

D = dt.date
FOLDER = "/root/testdata/sf0.001"


def test_schemas_are_complete():
    assert len(schema.COLUMNS) == 16 and set(schema.GRAINS) == set(schema.COLUMNS)
    assert len(schema.schema_of("dim_hcp")) == 20
    for name, grain in schema.GRAINS.items():
        assert set(grain) <= set(schema.schema_of(name).names)
    for name, keys in schema.FOREIGN_KEYS.items():
        for col, dim, key in keys:
            assert col in schema.schema_of(name).names and key in schema.schema_of(dim).names


def targets(spark, quarter, n):
    return spark.range(n).select(
        F.col("id").alias("coverage_key"), F.lit(quarter).alias("fiscal_quarter_key"),
        F.lit(1).alias("rep_key"), F.col("id").alias("hcp_key"), F.lit(3).alias("product_key"),
    )


def test_rebuild_replaces_only_its_folders(spark, tmp_path):
    root, name = str(tmp_path), "fct_hcp_coverage_target"
    io.rebuild(targets(spark, D(2023, 8, 1), 5), root, name)
    io.rebuild(targets(spark, D(2023, 11, 1), 3), root, name)
    io.rebuild(targets(spark, D(2023, 8, 1), 2), root, name)
    df = io.read_table(spark, root, name)
    assert df.schema == T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.schema_of(name)])
    assert rows(df.groupBy("fiscal_quarter_key").count(), "fiscal_quarter_key", "count") == [
        (D(2023, 8, 1), 2), (D(2023, 11, 1), 3),
    ]
    plan = df.filter("fiscal_quarter_key = date'2023-11-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fiscal_quarter_key" in plan


def weekly(spark, week, units):
    return spark.range(4).select(
        F.col("id").alias("prescription_key"), F.lit(week).alias("week_end_date_key"),
        F.col("id").alias("hcp_key"), F.lit(1).alias("product_key"), F.lit(1).alias("territory_key"),
        *[F.lit(units).alias(c) for c in
          ("new_rx_count", "total_rx_count", "total_units", "brand_units", "total_market_units")],
    )


def test_append_batch_is_repeatable(spark, tmp_path):
    root, name, week = str(tmp_path), "fct_prescription_weekly", D(2024, 3, 3)
    io.append_batch(weekly(spark, week, 1), root, name, 5)
    io.append_batch(weekly(spark, week, 2), root, name, 6)
    io.append_batch(weekly(spark, week, 1), root, name, 5)  # the same batch after a failure
    df = io.read_table(spark, root, name)
    assert rows(df.groupBy("audit_key").agg(F.sum("total_units").alias("u")), "audit_key", "u") == [(5, 4), (6, 8)]
    assert df.filter("group_key is not null").count() == 0


def test_a_batch_loaded_again_without_a_period_loses_it(spark, tmp_path):
    root, name = str(tmp_path), "fct_prescription_weekly"
    both = weekly(spark, D(2024, 3, 3), 1).unionByName(weekly(spark, D(2024, 3, 10), 1))
    io.append_batch(both, root, name, 7)
    io.append_batch(weekly(spark, D(2024, 3, 3), 1), root, name, 8)
    io.append_batch(weekly(spark, D(2024, 3, 3), 1), root, name, 7)
    df = io.read_table(spark, root, name)
    assert rows(df.groupBy("audit_key", "week_end_date_key").count(), "audit_key", "count") == [(7, 4), (8, 4)]


def test_rebuild_as_a_whole_drops_folders_that_vanish(spark, tmp_path):
    root, name = str(tmp_path), "fct_hcp_coverage_target"
    io.rebuild(targets(spark, D(2023, 8, 1), 5).unionByName(targets(spark, D(2023, 11, 1), 3)), root, name)
    io.rebuild(targets(spark, D(2023, 8, 1), 2), root, name, whole=True)
    df = io.read_table(spark, root, name)
    assert rows(df.groupBy("fiscal_quarter_key").count(), "fiscal_quarter_key", "count") == [(D(2023, 8, 1), 2)]


def test_conform_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="coverage_key, fiscal_quarter_key"):
        io.conform(spark.range(1).select(F.col("id").alias("rep_key")), "fct_hcp_coverage_target")


def test_csv_batch_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "rx.csv").write_text("week,hcp,n\n2024-03-03,1,5\n2024-03-03,x,6\n2024-03-03,2,7\n")
    kind = T.StructType([
        T.StructField("week", T.DateType()), T.StructField("hcp", T.LongType()), T.StructField("n", T.IntegerType()),
    ])
    batch = io.read_batch(spark, str(tmp_path / "in"), kind)
    assert rows(io.accepted(batch), "hcp", "n") == [(1, 5), (2, 7)]
    assert rows(io.rejected(batch), io.CORRUPT) == [("2024-03-03,x,6",)]
    assert io.accepted(batch).count() == 2 and io.rejected(batch).count() == 1
    assert tuple(io.batch_counts(batch).first()) == (3, 2, 1)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_sink_keeps_order(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    report = spark.range(100).select((F.lit(99) - F.col("id")).alias("n")).orderBy("n")
    io.write_report(report, path, fmt)
    files = sorted(p for p in (tmp_path / fmt).iterdir() if p.name.startswith("part-"))
    read = spark.read.option("header", True).format(fmt)
    seen = [int(x["n"]) for p in files for x in read.load(str(p)).collect()]
    assert seen == list(range(100))


def test_clustered_fact_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = spark.range(10_000).select((F.col("id") % 100).alias("hcp_key"), F.col("id").alias("week"))
    io.write_fact(df, path, ["hcp_key", "week"], files=5)
    back = spark.read.parquet(path).filter("hcp_key = 7")
    assert "EqualTo(hcp_key,7)" in back._jdf.queryExecution().executedPlan().toString()
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("hcp_key").alias("lo"), F.max("hcp_key").alias("hi")
    ).orderBy("lo").collect()
    assert len(spans) == 5
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    a = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    b = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("y"))
    io.write_bucketed(a, "bucket_a", str(tmp_path / "a"), ["k"], 4)
    io.write_bucketed(b, "bucket_b", str(tmp_path / "b"), ["k"], 4)
    joined = spark.table("bucket_a").hint("merge").join(spark.table("bucket_b"), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and joined.count() == 1000
    spark.sql("drop table bucket_a")
    spark.sql("drop table bucket_b")


def test_whole_star_is_stored_and_sound(spark, tmp_path):
    star = load.load_star(spark, FOLDER)
    stored = load.export_star(star, str(tmp_path))
    assert "fct_prescription_weekly" in stored
    table = {name: io.read_table(spark, str(tmp_path), name) for name in stored}
    for name, df in table.items():
        assert quality.duplicate_grain(df, schema.GRAINS[name]).count() == 0, name
        nulls = quality.null_counts(df, schema.required(name)).filter("null_rows > 0")
        assert nulls.count() == 0, (name, nulls.collect())
        for col, dim, key in schema.FOREIGN_KEYS.get(name, []):
            if dim in table and (name, col) != ("fct_quota_attainment", "audit_key"):
                assert quality.orphans(df, table[dim], col, key).count() == 0, (name, col)
        for col, n in schema.TEXT_LIMITS.get(name, {}).items():
            assert quality.too_long(df, {col: n}).count() == 0, (name, col)
        for col, n in schema.FIXED_WIDTHS.get(name, {}).items():
            assert quality.not_fixed_width(df, col, n).count() == 0, (name, col)
    for (name, col), allowed in schema.DOMAINS.items():
        if name in table:
            assert quality.outside_domain(table[name], col, allowed).count() == 0, (name, col)
    for name, key in [("dim_rep", "rep_durable_key"), ("dim_hcp", "hcp_durable_key"), ("dim_product", "brand_name")]:
        assert quality.scd_problems(table[name], key).count() == 0, name
    assert quality.weight_sums(table["bridge_hcp_rep_alignment"], ["group_key"]).count() == 0


def test_load_is_shared_and_follows_the_files(spark, tmp_path):
    first, again = load.Warehouse(spark, FOLDER), load.Warehouse(spark, FOLDER)
    assert first["dim_rep"].inputFiles() == again["dim_rep"].inputFiles()
    spark.range(3).write.parquet(str(tmp_path / "x.parquet"))
    before = load.fingerprint(spark, str(tmp_path))
    spark.range(5).write.mode("append").parquet(str(tmp_path / "x.parquet"))
    assert load.fingerprint(spark, str(tmp_path)) != before


def test_star_invariants(spark):
    star = SalesStar(spark, FOLDER)
    lines = star.raw("lineitem").agg(F.sum("l_quantity")).first()[0]
    for name, col in [("fct_prescription_weekly", "total_rx_count"), ("fct_quota_attainment", "actual_units"),
                      ("fct_prescription_territory_monthly", "total_rx_count")]:
        assert star[name].agg(F.sum(col)).first()[0] == lines
    assert star["fct_prescription_weekly"].filter("hcp_key is null").count() == 0
    assert star["fct_hcp_visit"].filter("rep_key is null or hcp_key is null").count() == 0


def test_a_load_that_fails_before_it_is_published_leaves_the_old_batch(spark, tmp_path, monkeypatch):
    root, name, week = str(tmp_path), "fct_prescription_weekly", D(2024, 3, 3)
    io.append_batch(weekly(spark, week, 1), root, name, 5)

    def stop(*args):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(io, "_publish", stop)
        with pytest.raises(RuntimeError):
            io.append_batch(weekly(spark, week, 9), root, name, 5)  # files written, not published
    df = io.read_table(spark, root, name)
    assert rows(df.groupBy("audit_key").agg(F.sum("total_units").alias("u")), "audit_key", "u") == [(5, 4)]
    # the next load of the batch takes a new version; the failed one is never read
    io.append_batch(weekly(spark, week, 2), root, name, 5)
    assert io.read_table(spark, root, name).agg(F.sum("total_units")).first()[0] == 8


def test_reloads_leave_one_version_and_vacuum_removes_the_rest(spark, tmp_path):
    root, name, week = str(tmp_path), "fct_prescription_weekly", D(2024, 3, 3)
    for units in (1, 2, 3):
        io.append_batch(weekly(spark, week, units), root, name, 5)
    io.append_batch(weekly(spark, week, 1), root, name, 6)
    df = io.read_table(spark, root, name)
    assert rows(df.groupBy("audit_key").agg(F.sum("total_units").alias("u")), "audit_key", "u") == [(5, 12), (6, 4)]
    before = sorted(p.name for p in (tmp_path / name / "audit_key=5").iterdir())
    assert before == ["_version=1", "_version=2", "_version=3"]
    gone = io.vacuum(spark, root, name)
    assert len(gone) == 2
    assert sorted(p.name for p in (tmp_path / name / "audit_key=5").iterdir()) == ["_version=3"]
    assert io.read_table(spark, root, name).count() == 8
    plan = io.read_table(spark, root, name).filter("audit_key = 6")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(audit_key" in plan


def test_a_table_rebuilt_empty_reads_empty(spark, tmp_path):
    root, name = str(tmp_path), "dim_audit"
    audit = spark.createDataFrame([], schema.schema_of(name))
    io.rebuild(audit, root, name, partitions=[])
    assert io.read_table(spark, root, name).count() == 0


def test_incremental_rollup_matches_a_full_rebuild(spark, tmp_path):
    from dimstar.operators import facts

    root = str(tmp_path)
    monthly = "fct_prescription_territory_monthly"

    def rx(week, hcp, units, batch):
        return (week, hcp, 1, hcp % 2, 1, 1, units, units, units * 2, batch)

    cols = ("week_end_date_key date, hcp_key long, product_key long, territory_key long, new_rx_count int, "
            "total_rx_count int, total_units long, brand_units long, total_market_units long, audit_key long")
    first = [rx(D(2024, 1, 7), h, 5, 1) for h in range(6)] + [rx(D(2024, 2, 4), h, 3, 1) for h in range(4)]
    bad = [rx(D(2024, 3, 3), h, 50, 2) for h in range(3)]
    fix = [rx(D(2024, 3, 3), h, 5, 3) for h in range(2)]  # restates the bad week with fewer rows
    later = [rx(D(2024, 4, 7), h, 7, 4) for h in range(5)]
    df = lambda rows: spark.createDataFrame(rows, cols)
    base = facts.monthly_rollup(df(first)).withColumn("territory_monthly_key", F.lit(1).cast("bigint"))
    io.rebuild(base, root, monthly)
    assert load.refresh_rollup(spark, root, df([]), df(bad)) == [D(2024, 3, 1)]
    assert load.refresh_rollup(spark, root, df(bad), df(fix)) == [D(2024, 3, 1)]
    assert load.refresh_rollup(spark, root, df([]), df(later)) == [D(2024, 4, 1)]
    stored = io.read_table(spark, root, monthly)
    rebuilt = facts.monthly_rollup(df(first + fix + later))
    measures = [*facts.ADDITIVE, "source_row_count", "market_share_pct"]
    assert quality.rollup_drift(stored, rebuilt, facts.ROLLUP_KEYS, measures).count() == 0
    # a correction that removes every row of a month drops the month
    load.refresh_rollup(spark, root, df(later), df([]))
    months = io.read_table(spark, root, monthly).select("month_key").distinct().collect()
    assert sorted(r[0] for r in months) == [D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)]
    plan = (io.read_table(spark, root, monthly).where(F.col("month_key").isin([D(2024, 3, 1)]))
            ._jdf.queryExecution().executedPlan().toString())
    assert "PartitionFilters: [isnotnull(month_key" in plan and "2024-03-01" in plan


def test_interleaved_layout_serves_entity_and_date(spark, tmp_path):
    import random

    rng = random.Random(3)
    data = [(h, D(2020, 1, 5) + dt.timedelta(weeks=w), rng.randint(1, 9)) for h in range(200) for w in range(104)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "hcp_key long, week date, units int").repartition(8)
    path = str(tmp_path / "fact")
    zones = io.write_interleaved(df, path, ["hcp_key", "week"], files=64, bits=6)
    assert zones.count() == 64
    one_hcp = io.files_meeting(zones, hcp_key=(7, 7))
    quarter = (D(2021, 1, 1), D(2021, 3, 31))
    one_quarter = io.files_meeting(zones, week=quarter)
    assert len(one_hcp) <= 16 and len(one_quarter) <= 24
    # the rows are those of the whole table, through the files the zones name
    got = spark.read.parquet(*one_hcp).where("hcp_key = 7").count()
    assert got == df.where("hcp_key = 7").count() == 104
    got = spark.read.parquet(*one_quarter).where(F.col("week").between(*quarter)).count()
    assert got == df.where(F.col("week").between(*quarter)).count()
    # clustering by the entity alone serves no date: a quarter meets every file
    io.write_fact(df, str(tmp_path / "by_hcp"), ["hcp_key", "week"], files=64)
    by_hcp = spark.read.parquet(str(tmp_path / "by_hcp")).groupBy(F.input_file_name().alias("file")).agg(
        F.min("week").alias("min_week"), F.max("week").alias("max_week"),
        F.min("hcp_key").alias("min_hcp_key"), F.max("hcp_key").alias("max_hcp_key"))
    assert len(io.files_meeting(by_hcp, week=quarter)) == 64
