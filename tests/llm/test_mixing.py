import random

from pyspark.sql import functions as F

from dimstar.llm.mixing import mix, mixed, split_quotas, targets
from tests.llm.shapes import empty_documents, odd_documents


def filled(sizes, weights):
    """Targets by sharing the excess anew until none is above its limit."""
    total, capped = 1.5 * sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(2 * sizes[i] for i in capped)
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > 2 * sizes[i]]
        if not over:
            return [2.0 * sizes[i] if i in capped else share[i] for i in range(len(sizes))]
        capped |= set(over)


def test_targets_are_shared_until_none_is_above(spark):
    rng = random.Random(3)
    for _ in range(4):
        sizes = [rng.choice([0, 1, 5, 40, 300]) for _ in range(7)] + [10]
        names = [f"s{i}" for i in range(7)] + [None]
        rows = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, size long")
        got = targets(rows).orderBy("sid").collect()
        assert [r["source"] for r in got] == names
        want = filled(sizes, [(3, 1, 2)[i % 3] for i in range(8)])
        assert all(abs(r["target"] - w) < 1e-6 for r, w in zip(got, want, strict=True))


def many(spark, n=3000):
    words = F.concat_ws(" ", F.expr("transform(sequence(1, 1 + cast(pmod(xxhash64(id), 60) as int)), x -> concat('w', x))"))
    source = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 8))
    return spark.range(n).select(F.col("id").alias("doc_id"), words.alias("text"), source.alias("source"))


def test_taken_words_are_near_targets_and_reruns_agree(spark):
    settings = {"block_words": 2000, "block_docs": 100}
    got = mix(many(spark), **settings).select("doc_id", "source", "size", "source_size", "target", "taken", "shards")
    rows = sorted(map(tuple, got.collect()), key=str)
    again = mix(many(spark).repartition(13), **settings).select(*got.columns)
    assert rows == sorted(map(tuple, again.collect()), key=str)
    by = {}
    for _, source, size, source_size, target, taken, shards in rows:
        assert taken == size * len(shards) <= 2 * size
        assert all(0 <= s < 8 for s in shards)
        s = by.setdefault(source, [source_size, target, 0, 0])
        s[2] += taken
        s[3] += size
    for source_size, target, taken, size in by.values():
        assert source_size == size
        assert abs(taken - target) <= 0.02 * target + 30


def test_mixture_holds_each_document_as_often_as_taken(spark):
    docs = many(spark, 600)
    taken = {r["doc_id"]: len(r["shards"]) for r in mix(docs, block_words=500).collect()}
    got = mixed(docs, block_words=500)
    assert got.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in taken.items() if n}


def test_quotas_are_split_exactly_and_by_chance(spark):
    quotas = spark.createDataFrame([(0, 40), (1, 0), (2, 25), (3, 1)], "sid int, quota long")
    lefts = []
    for seed in range(20):
        rows = split_quotas(quotas, levels=2, seed=seed).collect()
        sums = {}
        for r in rows:
            assert r["quota"] >= 0
            sums[r["sid"]] = sums.get(r["sid"], 0) + r["quota"]
        assert sums == {0: 40, 1: 0, 2: 25, 3: 1}
        sizes = [sum(r["quota"] for r in rows if r["shard"] == s) for s in range(4)]
        assert sum(sizes) == 66 and max(sizes) - min(sizes) <= 1
        lefts.append(sum(r["quota"] for r in rows if r["sid"] == 0 and r["shard"] < 2))
    mean = sum(lefts) / len(lefts)
    variance = sum((x - mean) ** 2 for x in lefts) / (len(lefts) - 1)
    assert abs(mean - 20) < 1.8  # hypergeometric: mean 20, variance 4
    assert 1 < variance < 12


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = mix(docs)
    assert got.count() == docs.count()
    assert {r["taken"] for r in got.where("size = 0").collect()} == {0}
    same = [r["taken"] for r in got.where("doc_id = 1").collect()]
    assert len(set(same)) == 1
    assert mixed(docs).columns == docs.columns
    assert mix(empty_documents(spark)).count() == 0
    assert mixed(empty_documents(spark)).count() == 0
