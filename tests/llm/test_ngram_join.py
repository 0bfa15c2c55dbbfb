import random

from dimstar.llm import ngram_join
from dimstar.llm.ngram_join import Similarity, one_per_group, similar_groups
from tests.llm.shapes import empty_documents, odd_documents


def brute(rows, like):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = max(1, len(words) - like.width + 1)
        sets.append({tuple(words[i : i + like.width]) for i in range(n)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= like.percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows))


def edited_texts(seed, n_bases=6, copies=25):
    rng = random.Random(seed)
    word = lambda: "w" + str(int(rng.paretovariate(0.5)) % 400)
    shared = [word() for _ in range(12)]
    out = []
    for _ in range(n_bases):
        base = [word() for _ in range(rng.choice([3, 6, 12, 40, 120]))]
        if rng.random() < 0.5:
            base = shared + base
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                text = text[: rng.randint(1, len(text))]
            out.append(" ".join(text).replace("w1", "W1"))
    return out


def run(spark, rows, like):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar_groups(docs, like).select("doc_id", "n_shingles", "component_id")
    return sorted(map(tuple, got.collect()))


def test_groups_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    for seed, like in ((1, Similarity(4, 85)), (2, Similarity(2, 60)), (3, Similarity(5, 80))):
        texts = edited_texts(seed)
        rows = [(1000 - i, t) for i, t in enumerate(texts)]
        assert run(spark, rows, like) == brute(rows, like)


def test_threshold_is_met_when_reached(spark):
    words = [f"a{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:85])), (3, " ".join(words[:84]))]
    like = Similarity(1, 85)
    assert run(spark, rows, like) == [(1, 100, 1), (2, 85, 1), (3, 84, 1)] == brute(rows, like)
    assert run(spark, rows[::2], like) == brute(rows[::2], like) == [(1, 100, 1), (3, 84, 3)]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in similar_groups(docs).collect()}
    assert got[(3, 0)] == 3 and got[(4, 0)] == 4 and got[(5, 0)] == 5 and got[(None, 0)] is None
    assert got[(2, 16)] == 1 and got[(7, 1)] == 7
    left = one_per_group(docs)
    assert left.columns == docs.columns
    # One text of the group of six rows, and the six others with all their rows.
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert similar_groups(empty_documents(spark)).count() == 0
    assert one_per_group(empty_documents(spark)).count() == 0


def test_every_group_keeps_one_text_whatever_its_ids(spark):
    told = lambda k: " ".join(f"{k}x{i}" for i in range(30))
    rows = [(None, told("a")), (None, told("b")), (None, told("b") + " more"), (None, told("c")), (None, told("c"))]
    rows += [(7, told("d")), (7, told("e")), (7, told("f")), (7, told("f") + " more"), (8, told("f"))]
    rows += [(None, told("g")), (9, told("g") + " more"), (5, told("h")), (6, told("h")), (None, None), (None, ""), (7, None)]
    left = [tuple(r) for r in one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert set(left) <= set(rows) and sum(not t for _, t in left) == 3
    kept = sorted((t[0], doc_id or 0) for doc_id, t in left if t)
    assert kept == [("a", 0), ("b", 0), ("c", 0), ("d", 7), ("e", 7), ("f", 7), ("g", 9), ("h", 5)]


def test_whole_rows_are_shuffled_once(spark):
    """One exchange for the rows, one for the ids that stay, also where nothing is broadcast."""
    docs = odd_documents(spark)
    want = sorted(map(str, one_per_group(docs).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = one_per_group(docs)
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, left.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2
    assert {r["doc_id"] for r in left.collect()} >= {3, 4, 5}
