"""URL filter: listed rules first, gradient-boosted trees on lexical features for the rest.

The URLs that a rule decides are the labelled ones the trees learn from. Features: length,
path depth, digit ratio, character entropy, parameter counts, and for the last one and the
last two labels of the host how many labelled URLs end so and which part of them is blocked.
The suffix statistics count every labelled URL; the trees are fitted on at most about
``max_training_urls`` distinct labelled URLs, chosen by a hash of the URL.

Defined results: a null URL and one without ``://`` have an empty host and path, fit no rule
and are judged by the trees on the features of an empty or host-less text; without labelled
URLs the method's verdict is ``allow``, with labels of one kind it is that kind; repeated rows
get the same verdict; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimstar.session import settled

MAX_TRAINING_URLS = 20_000
TREES, DEPTH, STEP, SEED = 20, 3, 0.2, 7
_PRIOR_ROWS = 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _last_labels(host: Column, n: int) -> Column:
    return F.substring_index(host, ".", -n)


def _entropy(text: Column) -> Column:
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    letters = F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1)))
    return F.aggregate(letters, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))


def _count(text: Column, what: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))).cast("double")


def parsed(pages: DataFrame, id_column: str, url_column: str) -> DataFrame:
    url = F.coalesce(F.col(url_column).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_column).alias("page_id"), url.alias("url"))
    after = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END")
    host = F.regexp_extract(F.coalesce(after, F.lit("")), r"^[^/?#]*", 0)
    path = F.regexp_extract(F.coalesce(after, F.lit("")), r"^[^/?#]*([^?#]*)", 1)
    return rows.withColumns({"host": F.translate(host, _UPPER, _LOWER), "path": path})


def matched_rule(rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of text and verdict; null if none does."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        at_host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = at_host & F.col("path").startswith(rule.path)
        named = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


_LEXICAL = ["length", "depth", "digit_ratio", "entropy", "n_parameters", "n_values"]
_SUFFIX = ["block_rate_1", "log_rows_1", "block_rate_2", "log_rows_2"]


def lexical(rows: DataFrame) -> DataFrame:
    url, n = F.col("url"), F.greatest(F.length("url"), F.lit(1))
    has_query = (F.instr(url, "?") > 0).cast("double")
    return rows.withColumns(
        {
            "length": F.length(url).cast("double"),
            "depth": _count(F.col("path"), "/"),
            "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / n,
            "entropy": F.when(F.length(url) > 0, _entropy(url)).otherwise(0.0),
            "n_parameters": has_query + _count(url, "&"),
            "n_values": _count(url, "="),
            "suffix_1": _last_labels(F.col("host"), 1),
            "suffix_2": _last_labels(F.col("host"), 2),
        }
    )


def _with_suffix_statistics(rows: DataFrame, labelled: DataFrame, base: float) -> DataFrame:
    for k in (1, 2):
        stats = labelled.groupBy(_last_labels(F.col("host"), k).alias(f"suffix_{k}")).agg(
            F.count("*").alias("n"), F.sum("label").alias("blocked")
        )
        rate = (F.col("blocked") + base * _PRIOR_ROWS) / (F.col("n") + _PRIOR_ROWS)
        rows = rows.join(
            stats.select(
                f"suffix_{k}", rate.alias(f"block_rate_{k}"), F.log1p("n").alias(f"log_rows_{k}")
            ),
            f"suffix_{k}",
            "left",
        )
        rows = rows.fillna({f"block_rate_{k}": base, f"log_rows_{k}": 0.0})
    return rows


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    max_training_urls: int = MAX_TRAINING_URLS,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, block_score (null if not judged
    by trees)."""
    rows = parsed(pages, id_column, url_column).withColumn("found", matched_rule(rules))
    # Distinct URLs with the label of their rule: what the statistics and the trees learn from.
    labelled = settled(
        rows.where("found is not null")
        .select("url", "host", "path", (F.col("found.verdict") == "block").cast("double").alias("label"))
        .distinct()
    )
    seen = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    n, blocked = seen["n"], seen["blocked"] or 0.0
    out = [
        "page_id",
        "host",
        "path",
        F.col("found.text").alias("rule"),
    ]
    if blocked in (0.0, float(n)):
        verdict = "block" if n and blocked else "allow"
        return rows.select(
            *out,
            F.coalesce("found.verdict", F.lit(verdict)).alias("verdict"),
            F.lit(None).cast("double").alias("block_score"),
        )
    base = blocked / n
    bits = 1 << 20
    cut = min(bits, int(bits * max_training_urls / n) + 1)
    sample = labelled.where(F.pmod(F.xxhash64("url"), F.lit(bits)) < cut)
    assembler = VectorAssembler(inputCols=_LEXICAL + _SUFFIX, outputCol="features")
    train = settled(
        _with_suffix_statistics(lexical(sample), labelled, base)
        .select("label", "url", *_LEXICAL, *_SUFFIX)
        .repartitionByRange(4, "url")
        .sortWithinPartitions("url")
    )
    model = GBTClassifier(
        labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, cacheNodeIds=False
    ).fit(assembler.transform(train).select("label", "features"))
    judged = model.transform(assembler.transform(_with_suffix_statistics(lexical(rows), labelled, base)))
    score = vector_to_array("probability")[1]
    by_trees = F.when(score >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        *out,
        F.coalesce("found.verdict", by_trees).alias("verdict"),
        F.when(F.col("found").isNull(), score).alias("block_score"),
    )
