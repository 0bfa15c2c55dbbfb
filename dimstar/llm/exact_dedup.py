"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Lengths and hashes of short prefixes are counted first; only rows whose length and prefix
occur twice bring their full hash to the grouping. All groups are pre-aggregated before they
are shuffled, so one text may hold any share of the rows.

Defined results: a null text counts as empty; empty texts are equal to each other; of equal
texts the row with the largest id stays and a null id is the smallest; of repeated rows (same
id, same text) exactly one stays; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.session import settled

PREFIX_CHARS = 64
_STEP = 1 << 16


def _hashed(docs: DataFrame, id_column: str, text_column: str, prefix_chars: int) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("prefix_hash"),
        F.sha2(text, 256).alias("text_sha256"),
    )


def duplicate_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """One row per text that occurs twice or more: text_sha256, keep_id, group_size, ties.

    ``ties`` counts the rows that carry the largest id.
    """
    rows = _hashed(docs, id_column, text_column, prefix_chars)
    by_length = rows.groupBy("n_bytes").count().where("count > 1").select("n_bytes")
    by_prefix = (
        rows.join(by_length, "n_bytes", "left_semi")
        .groupBy("n_bytes", "prefix_hash")
        .count()
        .where("count > 1")
        .select("n_bytes", "prefix_hash")
    )
    same_id = (
        rows.join(by_prefix, ["n_bytes", "prefix_hash"], "left_semi")
        .groupBy("text_sha256", "doc_id")
        .agg(F.count("*").alias("ties"))
    )
    return (
        same_id.groupBy("text_sha256")
        .agg(
            F.sum("ties").alias("group_size"),
            F.max(F.struct("doc_id", "ties")).alias("last"),
        )
        .where("group_size > 1")
        .select("text_sha256", F.col("last.doc_id").alias("keep_id"), "group_size", "last.ties")
    )


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    # Written, so that the join below has plain exchanges, whose hot partitions Spark can split.
    groups = settled(duplicate_groups(docs, id_column, text_column, prefix_chars))
    rows = _hashed(docs, id_column, text_column, prefix_chars).select("doc_id", "text_sha256")
    judged = rows.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce("ties", F.lit(1).cast("long")).alias("ties"),
        "text_sha256",
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    single = judged.where(~(stays & (F.col("ties") > 1))).select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256"
    )
    # Repeated rows of the id that stays are alike: the group's count writes them anew.
    tied = (
        groups.where("ties > 1")
        .withColumn("run", F.explode(F.expr(f"sequence(0, (ties - 1) div {_STEP})")))
        .withColumn(
            "at",
            F.explode(
                F.expr(f"sequence(run * {_STEP}, least(ties - 1, run * {_STEP} + {_STEP - 1}))")
            ),
        )
        .select(
            F.col("keep_id").alias("doc_id"),
            "keep_id",
            "group_size",
            (F.col("at") == 0).alias("kept"),
            "text_sha256",
        )
    )
    return single.unionByName(tied)


def deduplicated(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_column).alias("own_id"),
        F.sha2(text, 256).alias("text_sha256"),
    )
    groups = settled(duplicate_groups(docs, id_column, text_column, prefix_chars))
    left = rows.join(groups, "text_sha256", "left").where(
        F.col("group_size").isNull() | F.col("own_id").eqNullSafe(F.col("keep_id"))
    )
    several = F.coalesce("ties", F.lit(1)) > 1
    once = left.where(several).dropDuplicates(["own_id", "text_sha256"])
    return left.where(~several).unionByName(once).select("row.*")
