"""Embedding near-duplicates by range search in a robust-pruned flat graph.

Vectors are dealt to overlapping cells: each to the ``OVERLAP`` nearest of a number of
centroids that grows with the rows (at most ``MAX_CENTROIDS``, fitted on a bounded sample of at
most about ``SAMPLE`` vectors; every row is indexed). A cell too large for one task is cut into
parts by a hash and every part is held against every other, so nothing is left out.

Within a task the members are clustered once more into overlapping shards. Each shard gets a
graph: candidates are the nearest members and some by chance, and robust pruning drops a
candidate that a chosen one is much closer to. The shards' adjacency lists are united. A search
goes greedily from the shards' medoids with a beam, and from the vector's own place; then every
vector in range is expanded until no new one in range turns up. What it finds is verified in
double precision. Each task audits itself: some searches are repeated by brute force, and below
``RECALL`` it searches again with a wider beam, at last by comparing blocks. A vector's match
with itself does not count; where the repeated searches hold fewer than ``TRUE_PAIRS`` pairs,
more are repeated, up to all.

Equal vectors are one class, so copies are counted and never searched. A pair is counted in the
first of the cells it shares. Tasks return a row per linked class, with its links and the least
class it hangs together with; the rest is connected components.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing and are kept; vectors of different lengths do not link; repeated rows link with
each other; the smallest id ignores null ids; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.llm.components import components
from dimstar.session import settled

THRESHOLD = 0.95
SAMPLE, MAX_CENTROIDS, OVERLAP = 20_000, 1024, 3
CELL_ROWS, PART_ROWS, SHARD_ROWS = 4000, 8000, 1500
NEAREST, BY_CHANCE, DEGREE, MOST_DEGREE, ALPHA = 48, 16, 20, 48, 1.2
BEAM, QUERIES, AUDITED, TRUE_PAIRS, RECALL = 16, 256, 256, 100, 0.99
_SLACK = 1e-4


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids_of(x: np.ndarray, k: int, seed: int = 3, rounds: int = 8) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds if k > 1 else 1):
        own = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1)
        full = norms > 1e-9
        c = np.where(full[:, None], sums / np.maximum(norms, 1e-9)[:, None], c)
    return c


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """For each of ``nodes`` the candidates (a row of numbers) that stay, -1 where fewer do."""
    vectors = x[candidates]
    far = 2 - 2 * np.einsum("ncd,nd->nc", vectors, x[nodes])
    between = 2 - 2 * np.einsum("ncd,ned->nce", vectors, vectors, optimize=True)
    alive = candidates != nodes[:, None]
    rows = np.arange(len(nodes))
    out = np.full((len(nodes), DEGREE), -1)
    for k in range(DEGREE):
        best = np.where(alive, far, np.inf).argmin(axis=1)
        some = alive[rows, best]
        if not some.any():
            break
        out[some, k] = candidates[rows, best][some]
        alive &= ALPHA * between[rows, best] > far
        alive[rows, best] = False
    return out


def shard_edges(x: np.ndarray, members: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Edges (from, to) of one shard's graph, both ways."""
    n = len(members)
    if n < 2:
        return np.zeros((0, 2), np.int64)
    own = x[members]
    near = min(NEAREST, n - 1)
    found = []
    for at in range(0, n, 256):
        sims = own[at : at + 256] @ own.T
        top = np.argpartition(-sims, near, axis=1)[:, : near + 1]
        chance = rng.integers(0, n, (len(sims), BY_CHANCE))
        cand = members[np.concatenate([top, chance], axis=1)]
        nodes = members[at : at + 256]
        kept = robust_prune(x, nodes, cand)
        rows, cols = np.nonzero(kept >= 0)
        found.append(np.stack([nodes[rows], kept[rows, cols]], axis=1))
    edges = np.concatenate(found)
    return np.concatenate([edges, edges[:, ::-1]])


class FlatGraph:
    """The united graph of overlapping shards over the rows of ``x`` (unit, float32)."""

    def __init__(self, x: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.x = x
        n_shards = max(1, -(-2 * len(x) // SHARD_ROWS)) if len(x) > SHARD_ROWS else 1
        sims = x @ centroids_of(x, n_shards, seed, 4).T.astype(np.float32)
        nearest = np.argsort(-sims, axis=1)[:, :2]
        edges, medoids = [], []
        for s in range(sims.shape[1]):
            members = np.flatnonzero((nearest == s).any(axis=1))
            if len(members):
                medoids.append(members[sims[members, s].argmax()])
                # A shard that attracts too many is cut by chance; parts overlap in its medoid.
                pieces = np.array_split(rng.permutation(members), -(-len(members) // (2 * SHARD_ROWS)))
                edges += [shard_edges(x, np.union1d(p, medoids[-1:]), rng) for p in pieces]
        self.medoids = np.unique(medoids)
        self.neighbours = self._united(np.concatenate(edges), len(x))

    def _united(self, edges: np.ndarray, n: int) -> np.ndarray:
        """Adjacency lists as rows of numbers, -1 at their ends; of long lists the nearest stay."""
        if len(edges):
            codes = np.unique(edges[:, 0] * n + edges[:, 1])
            a, b = np.divmod(codes, n)
            far = -np.einsum("nd,nd->n", self.x[a], self.x[b])
            order = np.lexsort((far, a))
            a, b = a[order], b[order]
            first = np.searchsorted(a, np.arange(n))
            place = np.arange(len(a)) - first[a]
            short = place < MOST_DEGREE
            out = np.full((n, min(MOST_DEGREE, place.max() + 1)), -1)
            out[a[short], place[short]] = b[short]
            return out
        return np.full((n, 1), -1)

    def in_range(self, queries: np.ndarray, own: np.ndarray | None, threshold: float, beam: int) -> np.ndarray:
        """(query, row) pairs found with similarity of about ``threshold`` or more."""
        x, n_q, n = self.x, len(queries), len(self.x)
        seen = np.zeros((n_q, n), bool)
        rows = np.arange(n_q)
        starts = np.broadcast_to(self.medoids, (n_q, len(self.medoids)))
        if own is not None:
            starts = np.concatenate([starts, own[:, None]], axis=1)
        width = max(beam, starts.shape[1])
        ids = np.full((n_q, width), -1)
        sims = np.full((n_q, width), -np.inf, np.float32)
        ids[:, : starts.shape[1]] = starts
        sims[:, : starts.shape[1]] = np.einsum("qsd,qd->qs", x[starts], queries)
        seen[rows[:, None], starts] = True
        if own is not None:  # a medoid that is the query itself would stand twice
            twice = starts[:, :-1] == own[:, None]
            sims[:, : starts.shape[1] - 1][twice] = -np.inf
        closed = ~np.isfinite(sims)
        hits = [np.stack([np.repeat(rows, starts.shape[1]), starts.ravel()], 1)[(sims[:, : starts.shape[1]] >= threshold).ravel()]]
        while True:
            best = np.where(closed, -np.inf, sims).argmax(axis=1)
            going = np.flatnonzero(~closed[rows, best])
            if not len(going):
                break
            closed[going, best[going]] = True
            near = self.neighbours[ids[going, best[going]]]
            fresh = (near >= 0) & ~seen[going[:, None], near]
            seen[going[:, None], np.where(near >= 0, near, self.medoids[0])] = True
            s = np.einsum("qnd,qd->qn", x[near], queries[going], optimize=True)
            s[~fresh] = -np.inf
            q, k = np.nonzero(s >= threshold)
            hits.append(np.stack([going[q], near[q, k]], axis=1))
            ids_all = np.concatenate([ids[going], near], axis=1)
            sims_all = np.concatenate([sims[going], s], axis=1)
            closed_all = np.concatenate([closed[going], ~fresh], axis=1)
            top = np.argpartition(-sims_all, width - 1, axis=1)[:, :width]
            ids[going] = np.take_along_axis(ids_all, top, 1)
            sims[going] = np.take_along_axis(sims_all, top, 1)
            closed[going] = np.take_along_axis(closed_all, top, 1)
        frontier = np.concatenate(hits)
        found = [frontier]
        while len(frontier):
            near = self.neighbours[frontier[:, 1]]
            q = np.broadcast_to(frontier[:, :1], near.shape)
            fresh = (near >= 0) & ~seen[q, near]
            codes = np.unique(q[fresh] * n + near[fresh])
            q, near = np.divmod(codes, n)
            seen[q, near] = True
            s = np.einsum("nd,nd->n", x[near], queries[q])
            frontier = np.stack([q, near], axis=1)[s >= threshold]
            found.append(frontier)
        return np.concatenate(found)


def _by_blocks(x: np.ndarray, queries: np.ndarray, threshold: float) -> np.ndarray:
    out = [np.zeros((0, 2), np.int64)]
    for at in range(0, len(queries), QUERIES):
        out.append(np.argwhere(queries[at : at + QUERIES] @ x.T >= threshold) + [at, 0])
    return np.concatenate(out)


def _true_pairs(x: np.ndarray, queries: np.ndarray, own: np.ndarray | None, threshold: float) -> np.ndarray:
    """Codes (query * rows + row) of the pairs in range of some queries, or of all where few have
    any, by comparing blocks; without the pairs of a query with itself."""
    spread = np.random.default_rng(len(queries)).permutation(len(queries))
    truth = np.zeros(0, np.int64)
    for at in range(0, len(queries), AUDITED):
        asked = spread[at : at + AUDITED]
        pairs = _by_blocks(x, queries[asked], threshold)
        q, row = asked[pairs[:, 0]], pairs[:, 1]
        if own is not None:
            q, row = q[own[q] != row], row[own[q] != row]
        truth = np.concatenate([truth, q * len(x) + row])
        if len(truth) >= TRUE_PAIRS:
            break
    return np.unique(truth)


def search(
    x: np.ndarray, queries: np.ndarray, own: np.ndarray | None, threshold: float, beam: int = BEAM
) -> tuple[np.ndarray, float]:
    """(query, row) pairs in range after the audit, and the recall the audit measured last.

    ``own`` numbers the rows that are the queries themselves, if they are among the rows.
    """
    graph = FlatGraph(x.astype(np.float32))
    q32 = queries.astype(np.float32)
    low = threshold - _SLACK
    truth = _true_pairs(graph.x, q32, own, threshold + _SLACK)
    recall = 0.0
    for width in (beam, 2 * beam, 4 * beam):
        parts = []
        for at in range(0, len(queries), QUERIES):
            of = None if own is None else own[at : at + QUERIES]
            pairs = graph.in_range(q32[at : at + QUERIES], of, low, width)
            parts.append(pairs + [at, 0])
        found = np.concatenate(parts)
        if not len(truth):
            recall = 1.0
        else:
            codes = np.unique(found[:, 0] * len(x) + found[:, 1])
            recall = float(np.isin(truth, codes, assume_unique=True).mean())
        if recall >= RECALL:
            break
    else:
        found, recall = _by_blocks(graph.x, q32, low), 1.0
    exact = np.zeros(len(found), bool)
    for at in range(0, len(found), 1 << 18):
        part = found[at : at + (1 << 18)]
        exact[at : at + (1 << 18)] = np.einsum("nd,nd->n", queries[part[:, 0]], x[part[:, 1]]) >= threshold
    return found[exact], recall


def _least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _task(table: pa.Table, threshold: float) -> pa.Table:
    """Links of one cell, or of two parts of one: node, links, least, recall for linked nodes."""
    order = np.argsort(table.column("node").to_numpy(), kind="stable")
    node = table.column("node").to_numpy()[order]
    copies = table.column("copies").to_numpy()[order]
    part = table.column("part").to_numpy()[order]
    flat = table.column("embedding").combine_chunks().flatten().to_numpy()
    x = unit_rows(flat.reshape(len(node), -1)[order])
    cells = np.array(table.column("cells").to_pylist())[order]
    here = table.column("cell")[0].as_py()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    indexed, asking = np.flatnonzero(part == j), np.flatnonzero(part == i)
    none = np.zeros(0, np.int64)
    a, b, recall = none, none, 1.0
    if len(indexed) and len(asking):
        own = np.arange(len(asking)) if i == j else None
        found, recall = search(x[indexed], x[asking], own, threshold)
        a, b = asking[found[:, 0]], indexed[found[:, 1]]
        a, b = np.minimum(a, b), np.maximum(a, b)
        codes = np.unique((a * len(node) + b)[a != b])
        a, b = np.divmod(codes, len(node))
        # The pair belongs to the first cell that both are in.
        shared = (cells[a][:, :, None] == cells[b][:, None, :]).any(axis=2)
        first = np.where(shared, cells[a], np.iinfo(np.int64).max).min(axis=1)
        a, b = a[first == here], b[first == here]
    links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
    linked = np.flatnonzero(links)
    least = node[_least_reachable(len(node), a, b)]
    return pa.table(
        {
            "node": node[linked],
            "links": links[linked].astype(np.int64),
            "least": least[linked],
            "recall": np.full(len(linked), recall),
        }
    )


def classes_of(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows as vec_id, node (null if the vector links with nothing); and one row per distinct
    vector: node, embedding, dim, copies, least_id."""
    v = F.col(vector_column).cast("array<double>")
    usable = (
        (F.size(v) > 0)
        & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
        & F.exists(v, lambda e: e != 0)
    )
    rows = vectors.select(
        F.col(id_column).alias("vec_id"),
        F.when(F.coalesce(usable, F.lit(False)), v).alias("embedding"),
    ).withColumn("node", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding", F.size("embedding"))))
    distinct = (
        rows.where("node is not null")
        .groupBy("node", "embedding")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
        .withColumn("dim", F.size("embedding"))
    )
    return rows.select("vec_id", "node"), distinct


def with_cells(classes: DataFrame) -> DataFrame:
    """Adds ``cells``: the numbers of the nearest centroids among vectors of the same length."""
    counts = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    total = sum(counts.values())
    bits = 1 << 30
    draw = F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(bits)) < int(bits * min(1.0, SAMPLE / max(total, 1)))
    sample: dict[int, list] = {}
    for r in classes.where(draw).orderBy("node").select("dim", "embedding").collect():
        sample.setdefault(r["dim"], []).append(r["embedding"])
    fitted = {}
    for dim, vectors in sample.items():
        k = min(MAX_CENTROIDS, -(-counts[dim] * OVERLAP // CELL_ROWS))
        k = 1 if counts[dim] <= CELL_ROWS else max(k, OVERLAP)
        fitted[dim] = centroids_of(unit_rows(np.array(vectors)), k)
    shared = classes.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cells: list = [None] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                c = shared.value.get(int(dim))
                if c is None or len(c) == 1:
                    for i in at:
                        cells[i] = [0]
                    continue
                x = batch.column("embedding").take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
                top = np.argsort(-(unit_rows(x) @ c.T), axis=1, kind="stable")[:, :OVERLAP]
                for i, own in zip(at, np.sort(top, axis=1).tolist(), strict=True):
                    cells[i] = own
            names = ["node", "embedding", "dim", "copies", "cells"]
            arrays = [batch.column(c) for c in names[:4]] + [pa.array(cells, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return classes.select("node", "embedding", "dim", "copies").mapInArrow(
        run, "node long, embedding array<double>, dim int, copies long, cells array<long>"
    )


def links(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per linked class and task: node, links, least, recall."""
    placed = settled(with_cells(classes))
    each = placed.withColumn("cell", F.explode("cells"))
    sizes = settled(
        each.groupBy("dim", "cell").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    )
    parted = each.join(sizes, ["dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts")).cast("int")
    )
    tasks = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.least(p, "part").alias("i"), F.greatest(p, "part").alias("j")),
    )
    dealt = parted.select("*", F.inline(tasks))
    return dealt.groupBy("dim", "cell", "i", "j").applyInArrow(
        lambda table: _task(table, threshold), "node long, links long, least long, recall double"
    )


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    rows, distinct = classes_of(vectors, id_column, vector_column)
    classes = settled(distinct)
    found = settled(links(classes, threshold))
    groups = components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = settled(
        classes.select("node", "copies", "least_id")
        .join(counted, "node", "left")
        .join(groups, "node", "left")
        .select(
            "node",
            "least_id",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    least = settled(named.groupBy("root").agg(F.min("least_id").alias("component_id")))
    of_node = settled(named.join(least, "root").select("node", "n_links", "component_id"))
    out = rows.join(of_node, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def audit(vectors: DataFrame, found: DataFrame, every: int = 50, threshold: float = THRESHOLD) -> DataFrame:
    """Of the rows whose id is divisible by ``every``: vec_id, n_links (found), n_true (by
    comparing with all rows in blocks). The queries are shared; they are few by choice of
    ``every``."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        "embedding is not null"
    )
    asked = rows.where(F.col("vec_id") % every == 0).orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in asked])
    queries = unit_rows(np.array([r["embedding"] for r in asked]))
    shared = vectors.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = shared.value
        counts = np.zeros(len(own), np.int64)
        for batch in batches:
            if len(batch):
                x = unit_rows(batch.column("embedding").flatten().to_numpy().reshape(len(batch), -1))
                same = batch.column("vec_id").to_numpy()[:, None] == own[None, :]
                counts += ((x @ q.T >= threshold) & ~same).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(counts)], ["vec_id", "n"])

    truth = rows.mapInArrow(run, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n_true"))
    return truth.join(found.select("vec_id", "n_links"), "vec_id")
