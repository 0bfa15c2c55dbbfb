import numpy as np

from dimstar.llm import vector_graph
from dimstar.llm.vector_graph import audit, near_duplicates, robust_prune, search, unit_rows


def near_groups(seed=0, groups=12, dim=16):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=(300, dim))]
    for _ in range(groups):
        centre = rng.normal(size=dim)
        out.append(centre + rng.normal(size=(int(rng.integers(2, 40)), dim)) * rng.choice([0.05, 0.1, 0.2]))
    x = np.concatenate(out).astype(np.float32)
    return np.concatenate([x, x[:7], x[:3] * 0 + x[0]])


def brute(ids, x):
    x = unit_rows(x)
    linked = x @ x.T >= vector_graph.THRESHOLD
    label = np.array(ids)
    for _ in range(len(ids)):
        new = np.array([label[row].min() for row in linked])
        if (new == label).all():
            break
        label = new
    return sorted((int(i), int(row.sum()) - 1, int(c), bool(i == c)) for i, row, c in zip(ids, linked, label, strict=True))


def run(spark, rows):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(map(tuple, near_duplicates(vectors).collect()), key=str), vectors


def test_links_as_by_brute_force(spark):
    x = near_groups()
    ids = np.random.default_rng(5).permutation(len(x)) + 1
    got, vectors = run(spark, [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)])
    assert got == sorted(brute(ids, x), key=str)
    found = near_duplicates(vectors)
    rows = audit(vectors, found, every=5).collect()
    assert sum(r["n_links"] for r in rows) >= 0.9 * sum(r["n_true"] for r in rows) > 0


def test_cells_and_parts_lose_few_links(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 120), ("PART_ROWS", 60), ("SHARD_ROWS", 40)):
        monkeypatch.setattr(vector_graph, name, value)
    x = near_groups(3)
    ids = np.arange(len(x))
    got, _ = run(spark, [(int(i), v.tolist()) for i, v in enumerate(x)])
    want = brute(ids, x)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), want, strict=True))


def test_search_finds_what_blocks_find():
    x = unit_rows(near_groups(7))
    pairs, recall = search(x, x, np.arange(len(x)), 0.95)
    want = {tuple(p) for p in np.argwhere(x @ x.T >= 0.95).tolist()}
    got = {tuple(p) for p in pairs.tolist()}
    assert recall >= vector_graph.RECALL and got <= want and len(got) >= 0.99 * len(want)


def test_pruning_drops_what_a_chosen_one_is_closer_to():
    x = unit_rows(np.array([[1, 0.0], [1, 0.1], [1, 0.11], [0, 1]])).astype(np.float32)
    kept = robust_prune(x, np.array([0]), np.array([[0, 1, 2, 3]]))
    assert set(kept[0]) - {-1} == {1, 3}


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v), (2, v), (2, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]),
        (7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0]), (10, [2.0, 4.0, 6.0]),
        (None, [5.0, -1.0, 0.5]), (11, [1e30, 2e30, 3e30]),
    ]
    got, vectors = run(spark, rows)
    assert sorted(got, key=str) == sorted(
        [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (10, 4, 1, False), (11, 4, 1, False), (None, 0, None, True)]
        + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)],
        key=str,
    )
    assert near_duplicates(vectors.where("false")).count() == 0


def test_the_audit_sees_few_links_that_a_search_loses(monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 32))
    x[[5, 77, 301]] = x[[400, 401, 402]] + rng.normal(size=(3, 32)) * 0.01
    x, own = unit_rows(x), np.arange(600)
    in_range = vector_graph.FlatGraph.in_range

    def only_itself(self, queries, own, threshold, beam):
        found = in_range(self, queries, own, threshold, beam)
        return found[own[found[:, 0]] == found[:, 1]]

    monkeypatch.setattr(vector_graph.FlatGraph, "in_range", only_itself)
    pairs, _ = search(x, x, own, 0.95)
    want = {(5, 400), (77, 401), (301, 402)}
    assert {tuple(sorted(p)) for p in pairs.tolist() if p[0] != p[1]} == want
