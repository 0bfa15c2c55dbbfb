"""Sinks and sources over whole tables: what is written is read back and summed up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimstar.operators import facts
from dimstar.operators.dims import hash_key
from dimstar.plans import load
from dimstar.registry.base import Query
from dimstar.session import shared_folder
from dimstar.sources import adapter as ad
from dimstar.sources import io
from dimstar.sources.adapter import SalesStar
from dimstar.sources.schema import GRAINS

RX = "fct_prescription_weekly"
MONTHLY = "fct_prescription_territory_monthly"
DEAR = 400_000  # orders above this total have no readable total in the vendor file


def new_root(s: SalesStar) -> str:
    return f"{shared_folder(s.spark)}/io/{uuid.uuid4()}"


def appended(s: SalesStar) -> DataFrame:
    """Every batch, and the bad one first and again, as after a failed load."""
    root = new_root(s)
    loaded = s["rx_with_batches"].withColumns(
        {
            "brand_units": F.col("total_units"),
            "total_market_units": F.col("total_units"),
            "prescription_key": hash_key([*GRAINS[RX], "audit_key"]),
        }
    )
    batches = [r["audit_key"] for r in s["dim_audit"].select("audit_key").collect()]
    for batch in (ad.BAD_BATCH, *sorted(batches)):
        io.append_batch(loaded.filter(F.col("audit_key") == batch), root, RX, batch)
    return (
        io.read_table(s.spark, root, RX)
        .groupBy("audit_key", "week_end_date_key", "product_key")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("total_units").alias("total_units"))
    )


def rebuilt(s: SalesStar) -> DataFrame:
    root = new_root(s)
    rollup = s[MONTHLY].withColumn("territory_monthly_key", hash_key(GRAINS[MONTHLY]))
    io.rebuild(rollup, root, MONTHLY)
    return io.read_table(s.spark, root, MONTHLY)


def incremental(s: SalesStar) -> DataFrame:
    """The rollup of the ordinary batches, then the bad batch and its correction merged in.

    The correction counts for the period it restates and replaces the rows of earlier
    batches at that period and grain; only the touched month is read and written again.
    """
    root = new_root(s)
    grain = ["week_end_date_key", "hcp_key", "product_key", "territory_key"]
    loaded = s["rx_with_batches"].withColumns(
        {"brand_units": F.col("total_units"), "total_market_units": F.col("total_units")}
    )
    audit = s["dim_audit"].select("audit_key", "corrects_period")
    dated = loaded.join(audit, "audit_key", "left").withColumn(
        "week_end_date_key", F.coalesce("corrects_period", "week_end_date_key")
    )
    special = F.col("audit_key").isin(ad.BAD_BATCH, ad.FIX_BATCH)
    ordinary, bad = dated.where(~special), dated.where(F.col("audit_key") == ad.BAD_BATCH)
    fix = dated.where(F.col("audit_key") == ad.FIX_BATCH)
    base = facts.monthly_rollup(ordinary).withColumn("territory_monthly_key", hash_key(GRAINS[MONTHLY]))
    io.rebuild(base, root, MONTHLY)
    load.refresh_rollup(s.spark, root, bad.where(F.lit(False)), bad)
    restated = dated.where(F.col("audit_key") != ad.FIX_BATCH).join(fix, grain, "left_semi")
    load.refresh_rollup(s.spark, root, restated, fix)
    return io.read_table(s.spark, root, MONTHLY)


def clustered(s: SalesStar) -> DataFrame:
    path = new_root(s)
    io.write_fact(s[RX], path, ["hcp_key", "week_end_date_key"])
    return s.spark.read.parquet(path)


def vendor_batch(s: SalesStar) -> DataFrame:
    """Orders written as CSV with some unreadable totals, and read again."""
    path = new_root(s)
    total = F.when(F.col("o_totalprice") > DEAR, "n/a").otherwise(
        F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    )
    vendor = s.raw("orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderstatus",
        total.alias("total"),
    )
    io.write_report(vendor, path, "csv")
    kind = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_orderdate", T.DateType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("total", T.DecimalType(12, 2)),
        ]
    )
    return io.read_batch(s.spark, path, kind)


QUERIES = [
    Query(
        "io_append_batch",
        "audit_key:i week_end_date_key:t product_key:i row_count:i total_units:i",
        appended,
        f"SELECT audit_key, week_end_date_key, product_key, count(*) AS row_count, "
        f"sum(total_units) AS total_units FROM rx_with_batches GROUP BY ALL",
    ),
    Query(
        "io_rebuild",
        "month_key:t territory_rollup_key:i product_key:i total_units:i source_row_count:i",
        rebuilt,
        "SELECT *, territory_key AS territory_rollup_key FROM fct_monthly",
    ),
    Query(
        "io_incremental_rollup",
        "month_key:t territory_rollup_key:i product_key:i new_rx_count:i total_rx_count:i "
        "total_units:i source_row_count:i",
        incremental,
        "SELECT *, territory_key AS territory_rollup_key FROM fct_monthly",
    ),
    Query(
        "io_write_fact",
        "hcp_key:i product_key:i week_end_date_key:t territory_key:i total_units:i",
        clustered,
        f"SELECT * FROM {RX}",
    ),
    Query(
        "io_read_batch",
        "o_orderkey:i o_orderdate:t o_orderstatus:s total:d",
        lambda s: io.accepted(vendor_batch(s)),
        f"SELECT *, o_totalprice AS total FROM orders WHERE o_totalprice <= {DEAR}",
    ),
    Query(
        "io_batch_counts",
        "source_row_count:i loaded_row_count:i rejected_row_count:i",
        lambda s: io.batch_counts(vendor_batch(s)),
        f"SELECT count(*) AS source_row_count, count(*) FILTER (o_totalprice <= {DEAR}) AS "
        f"loaded_row_count, count(*) FILTER (o_totalprice > {DEAR}) AS rejected_row_count "
        f"FROM orders",
    ),
]
