"""Documents linked by the Jaccard similarity of their word shingles, exactly.

A pair as similar as asked shares one of its rarest shingles: of a set of n, the
n - ceil(threshold * n) + 1 that come first in any order common to all sets. Shingles are
ordered by the rarity of their rarest word, from a sketch of word counts over all documents,
so passages and lines that many documents share come last and bring no pairs. Documents that
share such a shingle form a tile.

Within tiles, documents are held against one of their tile, chosen anew in each round, and
what is linked becomes one group; only tiles that still hold several groups go on, at last
block by block, each document against each of the other groups. Sizes of sets come first
(a pair's sizes may differ by the threshold at most, so tiles are cut in bands of size), then
bitmaps of hashed shingles, with two bits a shingle or more: bits that differ bound the overlap
from above. Pairs that pass are settled by intersecting the sorted sets.

Documents with the same set are one class; a class enters a tile once for each task that meets
it. Pairs are never expanded inside classes or groups, no tile is gathered in a task, and no
candidate is dropped.

Defined results: words are what space and U+0009 to U+000D separate, A-Z lower-cased; with
fewer words than a shingle has, the whole sequence is one; null, empty and blank texts have no
shingles and link with nothing, not even each other; repeated rows are linked; where an id
repeats, its rows are told apart by their text; null ids count as the largest; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimstar.llm.components import components
from dimstar.llm.filters import filter_of, hit
from dimstar.llm.hashing import RollingHash
from dimstar.session import settled

SKETCH = 1 << 16
LEAST_BITS = 1024
ROUNDS = 2
BLOCK, SMALL = 256, 8
EARLIER = 32
WORD = r"[^\x20\x09-\x0D]"
_STORE = 400_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Words and shingles of texts as 64-bit hashes."""

    def __init__(self, width: int):
        self.width = width
        self.hash = RollingHash(505)
        rng = np.random.default_rng(width)
        self.factors = rng.integers(0, 1 << 63, max(width, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def words(self, text: str | None) -> np.ndarray:
        """Only A-Z are lower-cased in bytes."""
        return self.hash.words((text or "").encode("utf-8", "surrogatepass").lower())

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """In the order of the text; a short text is one shingle, told apart by its length."""
        width, n = self.width, len(words)
        if n == 0:
            return words
        size = min(width, n)
        sums = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            sums += words[k : n - size + 1 + k] * self.factors[k]
        return _mixed(sums + np.uint64((width - size) * int(_ODD[3]) % (1 << 64)))


def _class_id(shingle_set: np.ndarray) -> int:
    digest = hashlib.blake2b(shingle_set.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least percent / 100, 50 or more, of shingles of ``width`` words."""

    width: int = 5
    percent: int = 80

    def __post_init__(self) -> None:
        if self.width < 1 or not 50 <= self.percent <= 100:
            raise ValueError("a width from 1 and a percentage from 50 to 100 are needed")

    def prefix(self, n: int) -> int:
        return n - -(-n * self.percent // 100) + 1

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def overlap_fits(self, differing: Column, total: Column) -> Column:
        """``differing`` shingles at least are in one set only, of ``total`` in both."""
        return (total - differing) * (100 + self.percent) >= total * (2 * self.percent)


def parities(shingle_set: np.ndarray) -> np.ndarray:
    """A bitmap: whether an odd number of shingles has the hash of each place.

    Its places are a power of two, at least twice the shingles. A bitmap of half as many is
    the exclusive or of the two halves, so bitmaps of sets of different sizes can be compared.
    """
    places = max(LEAST_BITS, 1 << int(2 * len(shingle_set) - 1).bit_length())
    at = (shingle_set >> np.uint64(20)).astype(np.int64) % places
    odd = np.bincount(at, minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _halved(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _differing(a: Column, b: Column) -> Column:
    """Places that differ of two bitmaps as arrays, one of which may be twice as long."""
    xor = lambda x, y: x.bitwiseXOR(y)
    half = lambda x: F.zip_with(
        F.slice(x, F.lit(1), F.shiftright(F.size(x), 1)),
        F.slice(x, F.shiftright(F.size(x), 1) + 1, F.shiftright(F.size(x), 1)),
        xor,
    )
    fold = lambda x, y: F.when(F.size(x) > F.size(y), half(x)).otherwise(x)
    counts = F.zip_with(fold(a, b), fold(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(counts, F.lit(0), lambda s, x: s + x)


def _rough(bits: Column) -> Column:
    """Bitmaps folded to a quarter, though not below LEAST_BITS: from half a place a shingle."""
    least = F.lit(LEAST_BITS // 64)
    parts = F.when(F.size(bits) >= least * 4, 4).when(F.size(bits) >= least * 2, 2).otherwise(1)
    words = (F.size(bits) / parts).cast("int")
    xor = lambda x, y: x.bitwiseXOR(y)
    part = lambda k: F.slice(bits, words * k + 1, words)
    two = F.zip_with(part(0), part(1), xor)
    return (
        F.when(parts == 4, F.zip_with(two, F.zip_with(part(2), part(3), xor), xor))
        .when(parts == 2, two)
        .otherwise(bits)
    )


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(text_column).cast("string")
    return docs.select(
        F.col(id_column).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")
    )


def word_sketch(texts: DataFrame, width: int) -> np.ndarray:
    """Occurrences of words over all texts, summed over words with the same low hash bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(width), np.zeros(SKETCH, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                words = shingler.words(text.as_py()) % np.uint64(SKETCH)
                counts += np.bincount(words.astype(np.int64), minlength=SKETCH)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], ["cell", "n"])

    cells = texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = cells.toPandas()  # SKETCH rows at most
    sketch = np.zeros(SKETCH, np.int64)
    sketch[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return sketch


def signatures(texts: DataFrame, like: Similarity) -> DataFrame:
    """doc_id, text_hash, cid (class, null without shingles), n; and, where a task meets a class
    first, keys (its rarest shingles) and bits (parities of shingles by hash)."""
    sketch = texts.sparkSession.sparkContext.broadcast(word_sketch(texts, like.width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, met = Shingler(like.width), sketch.value, set()
        for batch in batches:
            cids, sizes, keys, bits = [], [], [], []
            for text in batch.column("text"):
                words = shingler.words(text.as_py())
                line = shingler.shingles(words)
                if not len(line):
                    cids.append(None), sizes.append(0), keys.append(None), bits.append(None)
                    continue
                found, first = np.unique(line, return_index=True)
                cid, n = _class_id(found), len(found)
                cids.append(cid), sizes.append(n)
                if cid in met:
                    keys.append(None), bits.append(None)
                    continue
                if len(met) > _STORE:
                    met.clear()
                met.add(cid)
                often = counts[(words % np.uint64(SKETCH)).astype(np.int64)]
                rarest = often[first]
                for k in range(1, min(like.width, len(words))):
                    rarest = np.minimum(rarest, often[first + k])
                rank = np.floor(np.log2(rarest) * 4).astype(np.int64)
                order = np.lexsort((found, rank))[: like.prefix(n)]
                keys.append(found[order].view(np.int64))
                bits.append(parities(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(cids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "cid", "n", "keys", "bits"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run,
        f"doc_id {kind}, text_hash long, cid long, n long, keys array<long>, bits array<long>",
    )


def _sets(texts: DataFrame, wanted: DataFrame, like: Similarity) -> DataFrame:
    """cid, shingles (sorted) of the classes whose text hashes are in ``wanted`` (h)."""
    shared = texts.sparkSession.sparkContext.broadcast(filter_of(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bits, met = Shingler(like.width), shared.value, set()
        for batch in batches:
            column, cids, sets = batch.column("text"), [], []
            for i in np.flatnonzero(hit(bits, batch.column("text_hash").to_numpy())):
                found = np.unique(shingler.shingles(shingler.words(column[int(i)].as_py())))
                cid = _class_id(found)
                if len(found) and cid not in met:
                    if len(met) > _STORE:
                        met.clear()
                    met.add(cid)
                    cids.append(cid)
                    sets.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["cid", "shingles"]
            )

    found = texts.select("text", "text_hash").mapInArrow(run, "cid long, shingles array<long>")
    return found.dropDuplicates(["cid"])


def _intersected(pairs: DataFrame, like: Similarity) -> DataFrame:
    """Of (a, b, set_a, set_b) the pairs (a, b) that are similar enough, and their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, near = [], []
            for i in range(len(batch)):
                a = batch.column("set_a")[i].values.to_numpy().view(np.uint64)
                b = batch.column("set_b")[i].values.to_numpy().view(np.uint64)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                if both * 100 >= like.percent * (len(a) + len(b) - both):
                    keep.append(i)
                    near.append(both / (len(a) + len(b) - both))
            found = batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*found.columns, pa.array(near, pa.float64())], ["a", "b", "near"])

    return pairs.mapInArrow(run, "a long, b long, near double")


def verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame, like: Similarity) -> DataFrame:
    """Of candidate pairs (a, b) the links (a, b, near: their similarity): bounded by sizes and
    bitmaps, then intersected."""
    of_a = classes.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"), F.col("text_hash").alias("hash_a"))
    of_b = classes.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"), F.col("text_hash").alias("hash_b"))
    differing = _differing(F.col("bits_a"), F.col("bits_b"))
    held = settled(
        pairs.distinct()
        .join(of_b, "b")
        .join(of_a, "a")
        .where(like.sizes_fit(F.col("n_a"), F.col("n_b")))
        .where(like.overlap_fits(differing, F.col("n_a") + F.col("n_b")))
        .select("a", "b", "hash_a", "hash_b")
    )
    wanted = held.select(F.col("hash_a").alias("h")).unionByName(held.select(F.col("hash_b").alias("h")))
    sets = settled(_sets(texts, wanted, like))
    with_b = held.select("a", "b").join(
        sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b")), "b"
    )
    with_both = with_b.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("set_a")), "a")
    return _intersected(with_both.select("a", "b", "set_a", "set_b"), like)


def _grouped(tiles: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Tiles that hold several groups: key, cid, group, and what else ``tiles`` has."""
    if groups is None:
        return tiles.withColumn("group", F.col("cid"))
    of = groups.withColumnsRenamed({"node": "cid", "root": "found"})
    named = tiles.join(of, "cid", "left").withColumn("group", F.coalesce("found", "cid")).drop("found")
    several = settled(
        named.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo <> hi").select("key")
    )
    return named.join(several, "key", "left_semi")


def _of_three(tiles: DataFrame) -> DataFrame:
    """Tiles of two are settled by their one pair; the others stay."""
    large = settled(tiles.groupBy("key").agg(F.count("*").alias("size")).where("size > 2").select("key"))
    return tiles.join(large, "key", "left_semi")


def _with_reach(tiles: DataFrame) -> DataFrame:
    """Adds reach, the number of the class's tiles: of near copies the least edited has most, as
    an edit puts shingles of its own among the rarest."""
    reach = settled(tiles.groupBy("cid").agg(F.count("*").cast("int").alias("reach")))
    return tiles.join(reach, "cid")


def _to_one(tiles: DataFrame, turn: int) -> DataFrame:
    """Pairs of each class with one of its tile, which is another in every turn.

    At first with the class of most tiles, then with the one that is closest to what it was held
    against: what near copies were made from is close to most of them, so these turns make most
    of them one group. Else by chance, half of the tiles in one order of the classes, half in
    another. Either way tiles that hold the same classes choose alike, so near copies bring few
    pairs.
    """
    salt = F.xxhash64(F.lit(turn), F.pmod("key", F.lit(2)))
    order = F.col("cid").bitwiseXOR(salt)
    far = -F.col("reach") if turn == 0 else -F.coalesce("near", F.lit(0.0))
    rank = F.struct(far.alias("far"), order.alias("order"))
    chosen = settled(
        tiles.groupBy("key").agg(F.min(rank)["order"].alias("first"), F.count("*").alias("size")).where("size > 1").select("key", "first")
    )
    joined = tiles.join(chosen, "key").withColumn("hub", F.col("first").bitwiseXOR(salt))
    pairs = joined.where("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b"), "group")
    of_hub = tiles.select(F.col("cid").alias("a"), F.col("group").alias("of_hub")).distinct()
    return pairs.distinct().join(of_hub, "a").where("group <> of_hub").select("a", "b")


def _in_small_tiles(tiles: DataFrame, classes: DataFrame, like: Similarity) -> DataFrame:
    """The same for tiles of SMALL classes at most, from sizes alone."""
    named = tiles.join(classes.select("cid", "n"), "cid")
    held = named.groupBy("key").agg(F.collect_list(F.struct("n", "cid", "group")).alias("held"))
    partners = lambda x: F.filter(
        "held",
        lambda y: (y["cid"] > x["cid"]) & (y["group"] != x["group"]) & like.sizes_fit(x["n"], y["n"]),
    )
    pairs = F.transform(
        "held",
        lambda x: F.transform(
            partners(x), lambda y: F.struct(x["cid"].alias("a"), y["cid"].alias("b"))
        ),
    )
    return held.select(F.inline(F.flatten(pairs)))


def _by_blocks(tiles: DataFrame, classes: DataFrame, like: Similarity) -> DataFrame:
    """All pairs of classes of different groups in a tile that sizes and bitmaps leave.

    A tile is dealt to blocks of about BLOCK classes and each block meets each, so no task
    holds a tile. Long texts are in many tiles, so their bitmaps go there folded; pairs that
    pass are held against the whole bitmaps once, when they are verified.

    Near copies share many tiles; a pair is compared in the first only: every class brings the
    EARLIER first of its tiles (before the one it is in), and a pair that shares one of them is
    left to it. A pair whose first common tile lies further on may come more than once.
    """
    sizes = settled(tiles.groupBy("key").agg(F.count("*").alias("size")))
    sized = tiles.join(sizes, "key")
    small = _in_small_tiles(sized.where(F.col("size") <= SMALL), classes, like)
    large = sized.where(F.col("size") > SMALL)
    first = settled(
        large.groupBy("cid").agg(F.slice(F.sort_array(F.collect_list("key")), 1, EARLIER).alias("first"))
    )
    dealt = (
        large.join(classes.select("cid", "n", _rough(F.col("bits")).alias("bits")), "cid")
        .join(first, "cid")
        .withColumn("earlier", F.filter("first", lambda k: k < F.col("key")))
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK))
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    )
    blocks = settled(
        dealt.groupBy("key", "blocks", "block").agg(
            F.sort_array(F.collect_list(F.struct("n", "cid", "group", "bits", "earlier"))).alias("held")
        )
    )
    alone = blocks.where("blocks = 1").select("held", F.col("held").alias("other"))
    several = blocks.where("blocks > 1")
    other = several.select("key", F.col("block").alias("other_block"), F.col("held").alias("other"))
    meet = alone.unionByName(
        several.join(other, "key").where("block <= other_block").select("held", "other")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns(cell: pa.ListScalar) -> tuple[np.ndarray, ...]:
            n, cid, group, bits, earlier = cell.values.flatten()
            # unsigned: numpy counts the bits of a negative number's absolute value
            maps = [np.asarray(x.values).view(np.uint64) for x in bits]
            keys = earlier.flatten().to_numpy()
            rows = np.repeat(np.arange(len(n)), earlier.value_lengths().to_numpy())
            return n.to_numpy(), cid.to_numpy(), group.to_numpy(), maps, rows, keys

        def met_before(n: int, rows: np.ndarray, keys: np.ndarray, m: int, rows2: np.ndarray, keys2: np.ndarray) -> np.ndarray:
            """Of each two (n x m) whether they share an earlier tile."""
            both = np.intersect1d(keys, keys2)
            marks = []
            for size, at, key in ((n, rows, keys), (m, rows2, keys2)):
                mark = np.zeros((size, len(both)), np.float32)
                place = np.minimum(np.searchsorted(both, key), max(len(both) - 1, 0))
                known = both[place] == key if len(both) else np.zeros(len(key), bool)
                mark[at[known], place[known]] = 1
                marks.append(mark)
            return marks[0] @ marks[1].T > 0

        for batch in batches:
            left, right = [], []
            for i in range(len(batch)):
                n, cid, group, bits, rows, keys = columns(batch.column("held")[i])
                m, cid2, group2, bits2, rows2, keys2 = columns(batch.column("other")[i])
                before = met_before(len(n), rows, keys, len(m), rows2, keys2)
                same = np.array_equal(cid, cid2)
                for k in range(len(n)):
                    # The other block is in the order of sizes: the band that fits is a run.
                    lo = np.searchsorted(m, -(-n[k] * like.percent // 100))
                    hi = np.searchsorted(m, n[k] * 100 // like.percent, "right")
                    if same:  # a block meets itself: each two once
                        lo = max(lo, k + 1)
                    apart = lo + np.flatnonzero((group2[lo:hi] != group[k]) & ~before[k, lo:hi])
                    differ = np.zeros(len(apart), np.int64)
                    for size in {len(bits2[j]) for j in apart}:
                        own = [i for i, j in enumerate(apart) if len(bits2[j]) == size]
                        words = min(size, len(bits[k]))
                        others = _halved(np.stack([bits2[apart[i]] for i in own]), words)
                        both = np.bitwise_count(_halved(bits[k], words) ^ others)
                        differ[own] = both.sum(axis=1, dtype=np.int64)
                    total = n[k] + m[apart]
                    at = apart[(total - differ) * (100 + like.percent) >= total * 2 * like.percent]
                    left.append(np.minimum(cid2[at], cid[k]))
                    right.append(np.maximum(cid2[at], cid[k]))
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([none, *left])), pa.array(np.concatenate([none, *right]))], ["a", "b"]
            )

    return meet.mapInArrow(run, "a long, b long").unionByName(small)


def _sketched_classes(signed: DataFrame) -> DataFrame:
    met = signed.where("keys is not null")
    return met.select("cid", "n", "bits", "text_hash").dropDuplicates(["cid"])


def _rooted(docs: DataFrame, like: Similarity, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """The signed documents; and one row per class: cid, root (of its component), first (the
    smallest id of the class, nulls last, and its smallest text hash)."""
    texts = _texts(docs, id_column, text_column)
    signed = settled(signatures(texts, like))
    classes = settled(_sketched_classes(signed))
    rows = signed.where("keys is not null").select("cid", F.explode("keys").alias("key"))
    shared = settled(
        rows.groupBy("key").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo <> hi").select("key")
    )
    tiles = settled(_with_reach(settled(rows.join(shared, "key", "left_semi").select("key", "cid").distinct())))
    links, groups = None, None
    for turn in range(ROUNDS):
        found = settled(verified(_to_one(settled(_grouped(tiles, groups)), turn), texts, classes, like))
        links = found if links is None else links.unionByName(found)
        groups = components(links)
        if turn + 1 < ROUNDS:
            near = settled(found.groupBy(F.col("b").alias("node")).agg(F.max("near").alias("near")))
            groups = groups.join(near, "node", "left")
        if turn == 0:
            tiles = settled(_of_three(tiles))
    left = settled(_grouped(tiles, groups))
    links = links.unionByName(settled(verified(_by_blocks(left, classes, like), texts, classes, like)))
    groups = components(links)

    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    own = signed.where("cid is not null").groupBy("cid").agg(F.min(first).alias("first"))
    of = groups.select(F.col("node").alias("cid"), "root")
    return signed, settled(own.join(of, "cid", "left").withColumn("root", F.coalesce("root", "cid")))


def similar_groups(
    docs: DataFrame,
    like: Similarity = Similarity(),  # noqa: B008 (frozen)
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id (the smallest id
    reachable by links)."""
    signed, rooted = _rooted(docs, like, id_column, text_column)
    least = settled(rooted.groupBy("root").agg(F.min("first")["doc_id"].alias("component_id")))
    named = settled(rooted.join(least, "root").select("cid", "component_id"))
    return signed.join(named, "cid", "left").select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_per_group(
    docs: DataFrame,
    like: Similarity = Similarity(),  # noqa: B008 (frozen)
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of each group the one with the
    smallest id (nulls last, then the smallest text hash), and of repeated rows one. Groups are
    told apart by their links, not by their ids; all rows without shingles stay."""
    _, rooted = _rooted(docs, like, id_column, text_column)
    one = settled(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash"))
    text = F.col(text_column).cast("string")
    # The join's keys are columns that the removal of repeated rows names again, so whole rows
    # are shuffled once for both; rows without a word need no join.
    keys = ["no_id", "own_id", "text_hash"]
    rows = docs.select(
        F.struct("*").alias("row"),
        *_id_keys(F.col(id_column)),
        F.xxhash64(text).alias("text_hash"),
        F.coalesce(text, F.lit("")).rlike(WORD).alias("worded"),
    )
    of_one = one.select(*_id_keys(F.col("doc_id")), "text_hash")
    shingled = rows.where("worded").join(of_one, keys).dropDuplicates(keys)
    return shingled.select("row.*").unionByName(rows.where("not worded").select("row.*"))


def _id_keys(doc_id: Column) -> list[Column]:
    return [doc_id.isNull().alias("no_id"), F.coalesce(doc_id.cast("string"), F.lit("")).alias("own_id")]
