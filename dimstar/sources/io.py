"""Typed scans, batch loads, rebuilds, report output and file layout."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimstar.sources.schema import PARTITIONS, schema_of

CORRUPT = "_corrupt_record"
PARSED = "_parsed"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the star schema with its stated types; nothing is inferred.

    A table loaded through ``append_batch`` or ``rebuild`` is read through its manifest:
    only the latest published version of each unit (batch or folder) is read, so files
    of a load that has not been published yet, or that failed, are never seen.
    """
    schema = schema_of(name)
    paths = published_paths(spark, root, name)
    if paths is None:
        return spark.read.schema(schema).parquet(table_path(root, name)).select(*schema.names)
    if not paths:
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(schema)
        .option("basePath", table_path(root, name))
        .parquet(*paths)
        .select(*schema.names)
    )


# -- published versions -------------------------------------------------------------------
# A load writes its files under <table>/<unit column>=<unit>/_version=<v>/ (or
# <table>/_version=<v>/ for a table that is one unit), then appends one file to the
# table's manifest: (unit_col, unit, version, dropped) for every unit it replaced.
# Readers take the latest version of every unit that is not dropped. ``vacuum`` removes
# what no reader can reach any more. One writer per table at a time.
MANIFEST = "_manifest"
VERSION = "_version"
MANIFEST_SCHEMA = "unit_col string, unit string, version long, dropped boolean"


def manifest_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{MANIFEST}/{name}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system holds it."""
    return _exists(spark, path)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def manifest(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Every publication of the table, or None for a table without a manifest."""
    path = manifest_path(root, name)
    if not _exists(spark, path):
        return None
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def _current(spark: SparkSession, root: str, name: str) -> list | None:
    """(unit_col, unit, version) of the latest publication of every unit still present.

    One row per unit reaches the driver: units are batches or folders, not rows.
    """
    log = manifest(spark, root, name)
    if log is None:
        return None
    latest = log.groupBy("unit_col", "unit").agg(
        F.max_by(F.struct("version", "dropped"), "version").alias("last")
    )
    return [
        (r["unit_col"], r["unit"], r["last"]["version"])
        for r in latest.where(~F.col("last.dropped")).collect()
    ]


def _unit_path(table: str, unit_col: str, unit: str, version: int) -> str:
    inner = f"{unit_col}={unit}/" if unit_col else ""
    return f"{table}/{inner}{VERSION}={version}"


def published_paths(spark: SparkSession, root: str, name: str) -> list[str] | None:
    units = _current(spark, root, name)
    if units is None:
        return None
    table = table_path(root, name)
    return [_unit_path(table, c, u, v) for c, u, v in units]


def _next_version(spark: SparkSession, root: str, name: str) -> int:
    log = manifest(spark, root, name)
    last = None if log is None else log.agg(F.max("version")).first()[0]
    table = table_path(root, name)
    # versions written but never published count as taken as well
    on_disk = [
        int(v.split("=", 1)[1])
        for d in [table, *[f"{table}/{c}" for c in _children(spark, table)]]
        for v in _children(spark, d)
        if v.startswith(f"{VERSION}=")
    ]
    return max([last or 0, *on_disk]) + 1


def _write_version(df: DataFrame, table: str, unit_col: str, folders: Sequence[str], version: int):
    cols = [*([unit_col] if unit_col else []), VERSION, *folders]
    (
        _spread_for(df.withColumn(VERSION, F.lit(version)), [*([unit_col] if unit_col else []), *folders])
        .write.mode("append")
        .partitionBy(*cols)
        .parquet(table)
    )


def _publish(spark: SparkSession, root: str, name: str, rows: list[tuple]) -> None:
    """Appends one manifest file; the load becomes visible when it stands."""
    if rows:
        spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(
            manifest_path(root, name)
        )


def vacuum(spark: SparkSession, root: str, name: str) -> list[str]:
    """Deletes the folders of versions that no reader reaches; returns them.

    Run it when no load of the table is running: a load's files stand before it is
    published, and an unpublished version looks like a failed one.
    """
    current = _current(spark, root, name)
    if current is None:
        return []
    keep = {(c, u): v for c, u, v in current}
    table = table_path(root, name)
    gone = []
    unit_dirs = [("", "", table)] + [
        (d.split("=", 1)[0], d.split("=", 1)[1], f"{table}/{d}")
        for d in _children(spark, table)
        if "=" in d and not d.startswith(f"{VERSION}=")
    ]
    for col, unit, path in unit_dirs:
        for v in _children(spark, path):
            if v.startswith(f"{VERSION}=") and keep.get((col, unit)) != int(v.split("=", 1)[1]):
                fs, p = _fs(spark, f"{path}/{v}")
                fs.delete(p, True)
                gone.append(f"{path}/{v}")
    return gone


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns of a table in order and type; nullable ones that are missing become NULL."""
    schema = schema_of(name)
    missing = [f.name for f in schema if f.name not in df.columns and not f.nullable]
    if missing:
        raise ValueError(f"{name} lacks required columns: {', '.join(missing)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def _spread_for(df: DataFrame, folders: Sequence[str]) -> DataFrame:
    """One writer or a few per folder; adaptive execution splits the folders that are large."""
    return df.hint("rebalance", *folders) if folders else df


def append_batch(df: DataFrame, root: str, name: str, batch: int) -> None:
    """Adds the rows of one load batch, stamped with its key, as a new published version.

    The batch is the unit: a batch that is loaded again replaces itself as a whole, also
    where it now lacks periods it had before; other batches stay untouched. Its files
    are written first and published last, so readers see the old batch until then.
    """
    spark = df.sparkSession
    folders = PARTITIONS.get(name, [])
    stamped = conform(df.withColumn("audit_key", F.lit(batch).cast("bigint")), name)
    version = _next_version(spark, root, name)
    _write_version(stamped, table_path(root, name), "audit_key", folders, version)
    _publish(spark, root, name, [("audit_key", str(batch), version, False)])


def rebuild(
    df: DataFrame,
    root: str,
    name: str,
    partitions: Sequence[str] | None = None,
    whole: bool = False,
    replace: Sequence[str] = (),
) -> None:
    """Writes a derived table again as a new published version.

    With folder columns the first one is the unit: only the units that occur in ``df``
    are replaced, and with ``whole`` the units that no longer occur are dropped; so are
    the units named in ``replace`` (folder values as text) that ``df`` no longer has.
    Without folder columns the table is one unit.
    """
    spark = df.sparkSession
    folders = PARTITIONS.get(name, []) if partitions is None else list(partitions)
    table, rows = table_path(root, name), conform(df, name)
    version = _next_version(spark, root, name)
    unit_col, inner = (folders[0], folders[1:]) if folders else ("", [])
    _write_version(rows, table, unit_col, inner, version)
    if not unit_col:
        # no rows write no folder: the table is then published as empty
        empty = not _exists(spark, _unit_path(table, "", "", version))
        _publish(spark, root, name, [("", "", version, empty)])
        return
    written = [
        d.split("=", 1)[1]
        for d in _children(spark, table)
        if d.startswith(f"{unit_col}=") and _exists(spark, f"{table}/{d}/{VERSION}={version}")
    ]
    entries = [(unit_col, u, version, False) for u in written]
    if whole:
        entries += [
            (c, u, version, True)
            for c, u, _ in (_current(spark, root, name) or [])
            if c == unit_col and u not in written
        ]
    else:
        entries += [(unit_col, u, version, True) for u in replace if u not in written]
    _publish(spark, root, name, entries)


def read_batch(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> DataFrame:
    """Vendor CSV with a given schema, read once; bad rows keep their text.

    Every field is read as text and cast to its stated type afterwards. ``PARSED`` is
    true where the reader found the right number of fields and every field that is not
    empty casts; the stated columns then hold the typed values. Other rows keep their
    text in ``CORRUPT`` (the line as read, or its fields joined by commas where only a
    cast failed). The flag refers to every field, so no plan reads the corrupt-record
    column alone, which Spark refuses for raw CSV.
    """
    names = schema.names
    as_text = T.StructType(
        [T.StructField(n, T.StringType(), True) for n in names]
        + [T.StructField(CORRUPT, T.StringType(), True)]
    )
    raw = (
        spark.read.schema(as_text)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    flag = F.col(CORRUPT).isNull()
    for n in names:
        flag = flag & (F.col(n).isNull() | typed[n].isNotNull())
    line = F.concat_ws(",", *[F.coalesce(F.col(n), F.lit("")) for n in names])
    return raw.select(
        *[typed[n].alias(n) for n in names],
        F.when(~flag, F.coalesce(F.col(CORRUPT), line)).alias(CORRUPT),
        flag.alias(PARSED),
    )


def accepted(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col(PARSED)).drop(CORRUPT, PARSED)


def rejected(batch: DataFrame) -> DataFrame:
    return batch.filter(~F.col(PARSED)).drop(PARSED)


def batch_counts(batch: DataFrame) -> DataFrame:
    """Rows received, fit to load and rejected, for the audit dimension."""
    return batch.agg(
        F.count(F.lit(1)).alias("source_row_count"),
        F.count_if(F.col(PARSED)).alias("loaded_row_count"),
        F.count_if(~F.col(PARSED)).alias("rejected_row_count"),
    )


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Files in the order of the report: the parts of a sorted DataFrame are ranges."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_fact(
    df: DataFrame, path: str, cluster: Sequence[str], files: int | None = None
) -> None:
    """Clusters the files so that a filter on the leading columns skips row groups.

    The equality column of the usual filter comes first, the range column after it.
    Without a number of files, adaptive execution merges small neighbouring ranges.
    """
    (
        df.repartitionByRange(*([files] if files else []), *cluster)
        .sortWithinPartitions(*cluster)
        .write.mode("overwrite")
        .parquet(path)
    )


def write_dated_fact(
    df: DataFrame,
    path: str,
    folders: Sequence[str],
    cluster: Sequence[str],
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """One folder per date, rows sorted inside by ``cluster``; a hot date is split by AQE.

    ``finish`` adds columns that follow from others of the row, after the shuffle.
    """
    (
        finish(_spread_for(df, folders))
        .sortWithinPartitions(*folders, *cluster)
        .write.mode("overwrite")
        .partitionBy(*folders)
        .parquet(path)
    )


def write_interleaved(
    df: DataFrame, path: str, cols: Sequence[str], files: int, bits: int = 8
) -> DataFrame:
    """Files clustered on several columns at once; returns their zone table.

    Each column's values are cut into ``2**bits`` ranges at approximate quantiles (one
    aggregate; the cut points, ``2**bits`` per column, are all that reach the driver).
    The bits of the range numbers are interleaved into one key, rows are ranged by it
    over ``files`` files and sorted inside. A filter on any one column then meets a
    share of the files that shrinks with the filter, not only on the leading column.
    The zone table (file, and minimum and maximum of every column) is written beside
    the files as ``<path>_zones``; ``files_meeting`` reads it. NULL falls in range 0.
    """
    parts = 2**bits
    points = [i / parts for i in range(1, parts)]
    found = df.agg(*[F.percentile_approx(c, points, 10_000).alias(c) for c in cols]).first()
    ranks = []
    for c in cols:
        cuts = sorted({v for v in (found[c] or []) if v is not None})
        rank = F.lit(0)
        for cut in cuts:
            rank = rank + (F.col(c) > F.lit(cut)).cast("int")
        ranks.append(F.coalesce(rank, F.lit(0)).cast("long"))
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for k, rank in enumerate(ranks):
            at = bit * len(cols) + k
            key = key.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), at))
    (
        df.withColumn("_z", key)
        .repartitionByRange(files, "_z")
        .sortWithinPartitions("_z")
        .drop("_z")
        .write.mode("overwrite")
        .parquet(path)
    )
    spark = df.sparkSession
    zones = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(
        *[F.min(c).alias(f"min_{c}") for c in cols], *[F.max(c).alias(f"max_{c}") for c in cols]
    )
    zones.write.mode("overwrite").parquet(f"{path}_zones")
    return spark.read.parquet(f"{path}_zones")


def files_meeting(zones: DataFrame, **ranges: tuple) -> list[str]:
    """Files whose zone meets every ``column=(low, high)`` range (bounds included).

    One row per file reaches the driver: the zone table is metadata.
    """
    meets = F.lit(True)
    for c, (low, high) in ranges.items():
        meets = meets & (F.col(f"max_{c}") >= F.lit(low)) & (F.col(f"min_{c}") <= F.lit(high))
    return [r["file"] for r in zones.where(meets).select("file").collect()]


def write_bucketed(
    df: DataFrame, table: str, path: str, cols: Sequence[str], buckets: int
) -> None:
    """A bucketed table: joins on ``cols`` of two such tables need no shuffle."""
    (
        df.repartition(buckets, *cols)
        .write.mode("overwrite")
        .bucketBy(buckets, *cols)
        .sortBy(*cols)
        .option("path", path)
        .saveAsTable(table)
    )
