"""The load: star tables are derived once, written, and read by every report after that."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimstar.operators import facts
from dimstar.operators.dims import hash_key, surrogate_key
from dimstar.session import settled, shared_folder
from dimstar.sources import io
from dimstar.sources.adapter import FINISHED, SalesStar
from dimstar.sources.schema import GRAINS, PARTITIONS

# How written tables are clustered: the column reports filter by equality comes first.
# Tables that are not listed are either small or read once, and are derived where used.
LAYOUT = {
    "sales": [],
    "hcp_snapshots": ["custkey"],
    "hcp_versions": ["custkey"],
    "rep_versions": ["suppkey"],
    "dim_date": ["date_key"],
    "dim_month": ["month_key"],
    "dim_territory": ["territory_key"],
    "dim_territory_rollup": ["territory_rollup_key"],
    "dim_rep": ["rep_key"],
    "dim_hcp": ["hcp_key"],
    "dim_product": ["product_key"],
    "dim_audit": ["audit_key"],
    "bridge_hcp_rep_alignment": ["group_key"],
    "fct_hcp_visit": ["rep_key", "date_key"],
    "fct_prescription_weekly": ["hcp_key", "week_end_date_key"],
    "fct_quota_attainment": ["fiscal_quarter_key", "rep_key"],
    "fct_hcp_coverage_target": ["fiscal_quarter_key", "rep_key"],
    "fct_prescription_territory_monthly": ["month_key", "territory_rollup_key"],
    "shared_rx": ["group_key", "hcp_key"],
    "rx_with_batches": ["audit_key", "week_end_date_key"],
}
FACTS = [name for name in LAYOUT if name.startswith("fct_")] + ["shared_rx", "rx_with_batches"]


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Changes with the input files; listing them reads none."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime").cast("long"))
    )
    return "-".join(str(v) for v in files.first())


class Warehouse(SalesStar):
    """A star whose tables are written to the shared folder when they are first read.

    Facts with a date folder column (``PARTITIONS``) are stored in one folder per date,
    clustered inside by their layout: a literal date range prunes folders, and a join
    to a filtered date dimension prunes them at run time (dynamic partition pruning).

    What is written is kept for the running application and for the state of the input
    files, so reports on the same data share one load.
    """

    written: dict[tuple[str, str, str], dict[str, tuple[str, T.StructType]]] = {}

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder)
        app = spark.sparkContext.applicationId
        self._tables = self.written.setdefault((app, folder, fingerprint(spark, folder)), {})

    def stores(self, name: str) -> bool:
        return name in LAYOUT

    def has_written_sales(self) -> bool:
        return "sales" in self._tables

    def __getitem__(self, name: str) -> DataFrame:
        if name not in LAYOUT:
            return super().__getitem__(name)
        if name not in self._tables:
            df = super().__getitem__(name)
            path = f"{shared_folder(self.spark)}/star/{uuid.uuid4()}/{name}"
            if name in FINISHED:
                staged, finish = FINISHED[name]
                rows = super().__getitem__(staged)
                io.write_dated_fact(rows, path, PARTITIONS[name], LAYOUT[name], finish)
            elif name in PARTITIONS:
                io.write_dated_fact(df, path, PARTITIONS[name], LAYOUT[name])
            elif name in FACTS:
                io.write_fact(df, path, LAYOUT[name])
            else:
                df.write.parquet(path)
            self._tables[name] = (path, df.schema)
        path, schema = self._tables[name]
        # folder columns come last in a scan; the stated order is restored
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)


def load_star(spark: SparkSession, folder: str) -> Warehouse:
    """Writes every table of the layout and returns the warehouse."""
    star = Warehouse(spark, folder)
    for name in LAYOUT:
        star[name]
    return star


# The dense key each stored table gets in the order of its grain.
SURROGATES = {
    "fct_prescription_weekly": "prescription_key",
    "fct_quota_attainment": "quota_key",
    "fct_hcp_coverage_target": "coverage_key",
    "fct_prescription_territory_monthly": "territory_monthly_key",
}


EXPORTED = [
    "dim_date", "dim_month", "dim_territory", "dim_territory_rollup", "dim_rep", "dim_hcp",
    "dim_product", "dim_visit_flags", "dim_audit", "bridge_hcp_rep_alignment", *SURROGATES,
]


def export_star(star: SalesStar, root: str) -> list[str]:
    """Stores the tables in the stated schema, readable with ``read_table``."""
    stored = []
    for name in EXPORTED:
        df = star[name]
        if name in SURROGATES:
            df = surrogate_key(df, GRAINS[name], SURROGATES[name])
        io.rebuild(df, root, name, partitions=[])
        stored.append(name)
    return stored


MONTHLY = "fct_prescription_territory_monthly"


def refresh_rollup(
    spark: SparkSession,
    root: str,
    removed: DataFrame,
    added: DataFrame,
    measures: list[str] | None = None,
) -> list:
    """Brings the stored monthly rollup up to date with one batch, touching only its months.

    ``added`` are the weekly rows the batch brings, ``removed`` those it replaces (the
    batch's earlier load, or the rows a correction restates), each dated by the period
    it counts for. The signed sums are merged into the stored rows of the touched months
    alone, which a literal month filter prunes to their folders, and only those months
    are published again. Returns the touched months (one per month: metadata, not rows).
    """
    measures = measures or facts.ADDITIVE
    delta = settled(facts.rollup_delta(removed, added, measures))
    months = sorted(r["month_key"] for r in delta.select("month_key").distinct().collect())
    if not months:
        return []
    stored = io.read_table(spark, root, MONTHLY).where(F.col("month_key").isin(months))
    merged = facts.merge_rollup(stored, delta, measures)
    keyed = merged.withColumn("territory_monthly_key", hash_key(GRAINS[MONTHLY]))
    io.rebuild(keyed, root, MONTHLY, replace=[m.isoformat() for m in months])
    return months
