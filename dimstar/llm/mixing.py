"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source gets a target in words: its weight's part of ``share`` times all words, at most
``MOST_COPIES`` times its own words, the excess shared anew by weight. A source's documents
are hashed into blocks of about ``block_words`` words and the blocks stand in a permuted order.
The target is met by whole passes over all blocks and one last pass that stops at the target,
inside a block between documents. The blocks drawn from each source are its quota.

The quotas are exact and are dealt among 2**levels output shards by a tree: each node hands
half of its blocks to its left child, and how many of them come from each source is drawn from
the multivariate hypergeometric distribution, source after source. A shard then takes its own
run of every source's permuted blocks, so shards are disjoint, and its documents are put in
the order of a hash. All draws come from hashes of the seed: reruns agree.

No source is gathered in a task: running sums go over blocks in two levels, and only the block
that holds the end of a target is ranked by document. One row per source is folded in a task.

Defined results: the size of a null or empty text is 0; null is a source of its own, last in
code-point order; a source without words has target 0 and nothing of it is taken; repeated
rows are taken or left alike; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimstar.session import settled

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
BLOCK_WORDS = 1 << 17
BLOCK_DOCS = 4096
LEVELS = 3
_RUN = 1024


def _unit(hash_: Column) -> Column:
    """A hash as a number from 0 to below 1."""
    return F.shiftrightunsigned(hash_, 11) / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@dataclass(frozen=True)
class MixPlan:
    """What every document's part follows from; sources and blocks are small next to the rows."""

    sources: DataFrame  # source, sid, words, target, passes, rest, blocks
    blocks: DataFrame  # sid, block, shards (one per pass), last_shard, is_whole, is_cut
    cut: DataFrame  # sid, block, h of the documents taken from blocks that hold a target's end


def sized(docs: DataFrame, id_column: str, source_column: str, text_column: str, seed: int) -> DataFrame:
    """row (all columns), doc_id, source, size, h."""
    text = F.col(text_column).cast("string")
    return docs.select(
        F.struct("*").alias("row"),
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_column), F.xxhash64(text)).alias("h"),
    )


def targets(
    rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE
) -> DataFrame:
    """One row per source: source, sid, words, docs, target."""
    per_source = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    listed = per_source.withColumn("sid", F.row_number().over(by_name) - 1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("sid"), F.lit(len(weights))))
    listed = listed.withColumns({"weight": weight, "cap": F.col("words") * float(MOST_COPIES)})
    # Sources reach their caps in the order of cap / weight. The level of the water is the
    # highest of what is left for the others at each step.
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("words").over(everything) * share
    filled = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    listed = listed.withColumn("level", (total - filled) / F.sum("weight").over(onwards))
    level = F.max("level").over(everything)
    target = F.least(F.col("cap"), F.col("weight") * level)
    return listed.select("source", "sid", "words", "docs", target.alias("target"))


def _hypergeometric(population: Column, marked: Column, draws: Column, u: Column) -> Column:
    """The number of marked ones among ``draws`` of ``population``, by inversion of ``u``.

    The sum runs over 12 standard deviations to both sides of the mean; what lies beyond is
    below the precision of a double.
    """
    zero = F.lit(0).cast("long")
    n = F.greatest(population, F.lit(1)).cast("double")
    mean = draws * marked / n
    spread = F.sqrt(mean * (n - marked) / n * (n - draws) / F.greatest(n - 1, F.lit(1.0))) * 12 + 12
    low = F.greatest(zero, draws - (population - marked), F.floor(mean - spread).cast("long"))
    high = F.least(draws, marked, F.ceil(mean + spread).cast("long"))

    def picked(e: Column) -> Column:
        N, K, k = e["population"], e["marked"], e["draws"]
        following = lambda w, x: (
            w * ((K - x) * (k - x).cast("double")) / ((x + 1) * (N - K - k + x + 1).cast("double"))
        )
        xs = F.sequence(e["low"], e["high"])
        one, none = F.lit(1.0), F.lit(0.0)
        total = F.aggregate(
            xs,
            F.struct(one.alias("w"), none.alias("s")),
            lambda a, x: F.struct(following(a["w"], x).alias("w"), (a["s"] + a["w"]).alias("s")),
        )["s"]
        steps = F.aggregate(
            xs,
            F.struct(one.alias("w"), none.alias("s"), zero.alias("steps"), total.alias("all")),
            lambda a, x: F.struct(
                following(a["w"], x).alias("w"),
                (a["s"] + a["w"]).alias("s"),
                (a["steps"] + F.when(a["s"] + a["w"] <= e["u"] * a["all"], 1).otherwise(0)).alias("steps"),
                a["all"].alias("all"),
            ),
        )["steps"]
        return F.least(e["low"] + steps, e["high"])

    inputs = F.struct(
        population.alias("population"), marked.alias("marked"), draws.alias("draws"), u.alias("u"),
        low.alias("low"), F.greatest(low, high).alias("high"),
    )
    return _let(inputs, picked)


def split_quotas(quotas: DataFrame, levels: int = LEVELS, seed: int = 0) -> DataFrame:
    """From (sid, quota) to (shard, sid, quota): shards of equal size, drawn without replacement."""
    held = F.collect_list(F.struct("sid", F.col("quota").cast("long").alias("quota")))
    nodes = quotas.agg(F.array_sort(held).alias("held"))
    nodes = nodes.withColumn("shard", F.lit(0).cast("long"))
    for level in range(levels):
        size = F.aggregate("held", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        start = F.struct(
            F.col("size").alias("population"),
            F.expr("size div 2").alias("draws"),
            F.array().cast("array<struct<sid:int,quota:bigint>>").alias("left"),
        )

        key = [F.lit(seed), F.lit(level), F.col("shard")]

        def step(a: Column, x: Column) -> Column:
            u = _unit(F.xxhash64(*key, x["sid"]))  # noqa: B023 (read before the next level)
            drawn = _hypergeometric(a["population"], x["quota"], a["draws"], u)
            return _let(
                F.struct(drawn.alias("d"), a.alias("a")),
                lambda e: F.struct(
                    (e["a"]["population"] - x["quota"]).alias("population"),
                    (e["a"]["draws"] - e["d"]).alias("draws"),
                    F.array_append(
                        e["a"]["left"],
                        F.struct(x["sid"].alias("sid"), e["d"].alias("quota")),
                    ).alias("left"),
                ),
            )

        split = nodes.withColumn("size", size).withColumn("left", F.aggregate("held", start, step)["left"])
        right = F.zip_with(
            "held", "left", lambda h, x: F.struct(h["sid"].alias("sid"), (h["quota"] - x["quota"]).alias("quota"))
        )
        children = F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.col("left").alias("held")),
            F.struct((F.col("shard") * 2 + 1).alias("shard"), right.alias("held")),
        )
        nodes = split.select(F.inline(children))
    return nodes.select("shard", F.inline("held"))


def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with their source's numbers and the block their hash falls into."""
    s = sources.withColumnRenamed("source", "of_source")
    joined = rows.join(s, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    return joined.withColumn("block", F.floor(_unit(F.col("h")) * F.col("blocks")).cast("long"))


def _running(blocks: DataFrame, value: str) -> DataFrame:
    """Adds ``before`` (sum of value) and ``position`` in the permuted order, in two levels."""
    run = F.floor(_unit(F.col("o")) * F.ceil(F.col("blocks") / _RUN)).cast("long")
    b = blocks.withColumn("run", run)
    sums = b.groupBy("sid", "run").agg(F.sum(value).alias("run_sum"), F.count("*").alias("run_rows"))
    earlier = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "sid",
        "run",
        F.coalesce(F.sum("run_sum").over(earlier), F.lit(0)).alias("sum_before"),
        F.coalesce(F.sum("run_rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("sid", "run").orderBy("o", "block")
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    return b.join(sums, ["sid", "run"]).select(
        *blocks.columns,
        (F.col("sum_before") + F.coalesce(F.sum(value).over(ahead), F.lit(0))).alias("before"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("position"),
    )


def plan_mix(
    small: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    levels: int = LEVELS,
    seed: int = 0,
    block_words: int = BLOCK_WORDS,
    block_docs: int = BLOCK_DOCS,
) -> MixPlan:
    """From rows of (source, size, h), which are read several times."""
    share_of = targets(small, weights, share)
    passes = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0)
    cells = F.greatest(
        F.ceil(F.col("words") / block_words), F.ceil(F.col("docs") / block_docs), F.lit(1)
    )
    sources = settled(
        share_of.withColumns({"passes": passes.cast("long"), "blocks": cells.cast("long")}).withColumn(
            "rest", F.col("target") - F.col("passes") * F.col("words")
        )
    )
    blocks = (
        _placed(small, sources)
        .groupBy("sid", "block")
        .agg(
            F.sum("size").alias("words"),
            *[F.first(c).alias(c) for c in ("passes", "blocks", "rest")],
        )
        .withColumn("o", F.xxhash64(F.lit(seed), F.lit("block"), "sid", "block"))
    )
    after = F.col("before") + F.col("words")
    ordered = settled(
        _running(blocks, "words").withColumns(
            {
                "is_whole": (F.col("words") > 0) & (after <= F.col("rest")),
                "is_cut": (F.col("before") < F.col("rest")) & (after > F.col("rest")),
            }
        )
    )
    drawn = (F.col("is_whole") | F.col("is_cut")).cast("long")
    # Slots of a source: pass by pass, each in permuted order, the last one cut short.
    numbered = ordered.groupBy("sid").agg(
        F.count("*").alias("n_blocks"), (F.count("*") * F.first("passes") + F.sum(drawn)).alias("quota")
    )
    dealt = split_quotas(numbered, levels, seed)
    earlier = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.withColumn("start", F.coalesce(F.sum("quota").over(earlier), F.lit(0)))
        .groupBy("sid")
        .agg(F.sort_array(F.collect_list("start")).alias("starts"))
    )
    shard_of = lambda slot: F.size(F.filter("starts", lambda s: s <= slot)) - 1
    slot = lambda k: k * F.col("n_blocks") + F.col("position")
    sharded = ordered.join(numbered.select("sid", "n_blocks"), "sid").join(starts, "sid")
    block_plan = settled(
        sharded.select(
            "sid",
            "block",
            F.when(
                F.col("passes") > 0,
                F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1), lambda k: shard_of(slot(k))),
            )
            .otherwise(F.array().cast("array<int>"))
            .alias("shards"),
            F.when(F.col("is_whole") | F.col("is_cut"), shard_of(slot(F.col("passes")))).alias("last_shard"),
            "is_whole",
            "is_cut",
            (F.col("rest") - F.col("before")).alias("left"),
        )
    )
    return MixPlan(sources, block_plan, _cut(small, sources, block_plan))


def _cut(small: DataFrame, sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """The documents taken from the blocks that hold the end of a target.

    They are taken in the order of their hash while they fit; then the one that brings the sum
    closest, if it does, is taken as well. Equal rows are decided alike.
    """
    ends = blocks.where("is_cut").select("sid", "block", "left")
    rows = _placed(small, sources).join(ends, ["sid", "block"])
    rows = rows.withColumn("mix", F.xxhash64(F.lit("cut"), "h"))
    order = Window.partitionBy("sid", "block").orderBy("mix")
    upto = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cell = Window.partitionBy("sid", "block")
    rows = rows.withColumn("fits", F.sum("size").over(upto) <= F.col("left"))
    got = F.coalesce(F.sum(F.when(F.col("fits"), F.col("size"))).over(cell), F.lit(0))
    rows = rows.withColumn("gap", F.col("left") - got)
    closest = F.when(~F.col("fits"), F.abs(F.col("size") - F.col("gap")))
    rows = rows.withColumn(
        "best", F.min(F.struct(F.coalesce(closest, F.lit(float("inf"))).alias("d"), "mix")).over(cell)
    )
    filler = ~F.col("fits") & (F.col("mix") == F.col("best.mix")) & (F.col("best.d") < F.col("gap"))
    return settled(rows.where(F.col("fits") | filler).select("sid", "block", "h").distinct())


def with_parts(rows: DataFrame, plan: MixPlan) -> DataFrame:
    """``rows`` (of ``sized``) with source_size, target, taken and shards (one per copy)."""
    cut = plan.cut.withColumn("is_taken", F.lit(True))
    placed = _placed(rows, plan.sources.select("source", "sid", F.col("words").alias("source_size"), "target", "blocks"))
    joined = placed.join(plan.blocks.drop("left"), ["sid", "block"], "left").join(
        cut, ["sid", "block", "h"], "left"
    )
    last = F.col("is_whole") | (F.col("is_cut") & F.col("is_taken").isNotNull())
    shards = F.when(last, F.array_append("shards", F.col("last_shard"))).otherwise(F.col("shards"))
    return joined.select(*rows.columns, "source_size", "target", shards.alias("shards")).withColumn(
        "taken", F.col("size") * F.size("shards")
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    seed: int = 0,
    **settings,
) -> DataFrame:
    """One row per document: row, doc_id, source, size, source_size, target, taken, shards."""
    rows = sized(docs, id_column, source_column, text_column, seed)
    small = settled(rows.select("doc_id", "source", "size", "h"))
    plan = plan_mix(small, seed=seed, **settings)
    return with_parts(small, plan).drop("h")


def mixed(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    seed: int = 0,
    **settings,
) -> DataFrame:
    """The mixture itself: the columns of ``docs``, a row per copy taken, shard by shard, each
    shard's documents in the order of a hash."""
    rows = sized(docs, id_column, source_column, text_column, seed)
    plan = plan_mix(settled(rows.select("source", "size", "h")), seed=seed, **settings)
    parts = with_parts(rows, plan).where(F.size("shards") > 0)
    copies = parts.select("row", "h", F.posexplode("shards").alias("copy", "shard"))
    place = F.xxhash64(F.lit(seed), F.lit("order"), "copy", "h")
    return (
        copies.withColumn("place", place)
        .repartitionByRange(F.col("shard"), F.col("place"))
        .sortWithinPartitions("shard", "place")
        .select("row.*")
    )
