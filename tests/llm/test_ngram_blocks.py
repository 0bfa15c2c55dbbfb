"""Block stage of the n-gram join: folded bitmaps, the same links."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimstar.llm import ngram_join as nj


@pytest.mark.parametrize("n", [1, 300, 512, 513, 1024, 1025, 5000, 20000])
def test_rough_bitmaps_are_folded_and_never_below_the_least(spark, n):
    rng = np.random.default_rng(n)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(2)]
    whole = [nj.parities(s) for s in sets]
    rows = spark.createDataFrame([(w.tolist(),) for w in whole], "bits array<long>")
    rough = [np.array(r[0], np.int64) for r in rows.select(nj._rough(F.col("bits"))).collect()]
    words = max(nj.LEAST_BITS // 64, len(whole[0]) // 4)
    for w, r in zip(whole, rough, strict=True):
        assert np.array_equal(r, nj._halved(w, words))
    differ = lambda m: int(np.bitwise_count((m[0] ^ m[1]).view(np.uint64)).sum())
    assert differ(rough) <= differ(whole) <= len(np.setxor1d(*sets))


def test_blocks_carry_folded_bitmaps_and_lose_no_link(spark, monkeypatch):
    """One tile of twelve sets of 3,000 shingles, of which neighbours share 2,850."""
    longest = []
    real = nj.settled

    def spy(df, *args):
        if "held" in df.columns:
            size = F.expr("max(array_max(transform(held, x -> size(x.bits))))")
            longest.append(df.select(size).first()[0])
        return real(df, *args)

    monkeypatch.setattr(nj, "settled", spy)
    like = nj.Similarity(width=4, percent=85)
    pool = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 6000, dtype=np.uint64))
    sets = [pool[150 * i : 150 * i + 3000] for i in range(12)]
    tiles = spark.createDataFrame([(1, i, i) for i in range(12)], "key long, cid long, group long")
    classes = spark.createDataFrame(
        [(i, 3000, nj.parities(s).tolist()) for i, s in enumerate(sets)], "cid long, n long, bits array<long>"
    )
    found = {(r.a, r.b) for r in nj._by_blocks(tiles, classes, like).collect()}
    shared = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a in range(12) for b in range(a + 1, 12)}
    assert {ab for ab, n in shared.items() if 100 * n >= 85 * (6000 - n)} <= found
    assert not {ab for ab, n in shared.items() if n < 2100} & found
    # 3,000 shingles have a bitmap of 8,192 places, 128 words
    assert longest == [32]


def test_a_pair_of_many_tiles_is_made_once(spark):
    """Twenty tiles of the same 300 sets, in blocks that meet themselves and each other."""
    like = nj.Similarity(width=4, percent=85)
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 63, 150, dtype=np.uint64))
    sets = [np.unique(np.r_[base[: 150 - i % 13], rng.integers(0, 1 << 63, i % 13, dtype=np.uint64)]) for i in range(300)]
    tiles = spark.createDataFrame([(key, i, i) for key in range(20) for i in range(300)], "key long, cid long, group long")
    classes = spark.createDataFrame(
        [(i, len(s), nj.parities(s).tolist()) for i, s in enumerate(sets)], "cid long, n long, bits array<long>"
    )
    made = [(r.a, r.b) for r in nj._by_blocks(tiles, classes, like).collect()]
    shared = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a in range(300) for b in range(a + 1, 300)}
    assert {(a, b) for (a, b), n in shared.items() if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n)} <= set(made)
    assert len(made) == len(set(made))
    assert all(a < b for a, b in made)


def test_pairs_whose_common_tile_is_not_among_the_first_are_kept(spark, monkeypatch):
    """With one earlier tile to a class, pairs that meet in the last of three are still made."""
    monkeypatch.setattr(nj, "EARLIER", 1)
    like = nj.Similarity(width=4, percent=85)
    bits = nj.parities(np.arange(100, dtype=np.uint64) << np.uint64(20)).tolist()
    rows = [(1, i, i) for i in range(10)] + [(2, i, i) for i in range(10, 20)] + [(3, i, i) for i in range(20)]
    tiles = spark.createDataFrame(rows, "key long, cid long, group long")
    classes = spark.createDataFrame([(i, 100, bits) for i in range(20)], "cid long, n long, bits array<long>")
    made = {(r.a, r.b) for r in nj._by_blocks(tiles, classes, like).collect()}
    assert made == {(a, b) for a in range(20) for b in range(a + 1, 20)}


def test_the_first_turn_holds_near_copies_against_what_they_were_made_from(spark):
    """The source is in every tile, its copies in some: one turn makes them one group."""
    rows = [(key, 0) for key in range(12)] + [(key, i) for i in range(1, 60) for key in range(12) if (key + i) % 3]
    tiles = nj._with_reach(spark.createDataFrame(rows, "key long, cid long").withColumn("group", F.col("cid")))
    assert {(r.a, r.b) for r in nj._to_one(tiles, 0).collect()} == {(0, i) for i in range(1, 60)}
