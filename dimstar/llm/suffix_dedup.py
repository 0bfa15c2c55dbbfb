"""Bytes covered by long strings that occur again, found with suffix arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts at another place of the
corpus, in the same text or another; matches never cross texts, overlapping ones count, and all
strings are judged on the input.

Every string of LENGTH bytes has an anchor: of its ``GRAM``-byte grams the one with the smallest
hash, the last of equal ones. Equal strings have equal anchors at the same distance, so only
texts around grams that occur again need to meet. The strings of one anchor in a text form a
span. Where all spans around a gram are equal, all their strings occur again. The others are
contested; of each different span one copy goes to a shard by its gram.

A shard sorts the suffixes of its spans by Larsson-Sadakane refinement (order by 7 bytes, then
doubling, only groups that are not yet told apart are sorted again), takes common prefixes with
the preceding suffix by Kasai's rule, and reads off the strings whose prefix reaches LENGTH. The
spans of a very frequent gram are dealt to several shards; these cut their sorted lists of
strings at the borders of ranges by binary search, and a merge finds each list's strings in the
others' by binary search.

Equal texts are counted by hash and length and enter with one copy a task, so groups of copies
of any size are summed before a shuffle. Long texts are read in pieces. Only texts with
something to remove, or with contested spans, are shuffled; they are told by a filter of fixed
size.

Defined results: null counts as empty; texts shorter than LENGTH lose nothing; a repeated row
is a second occurrence of all its strings; a text may lose all its bytes; bytes are cut as
bytes, so a character may be cut; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.llm.filters import filter_of, hits
from dimstar.llm.hashing import RollingHash
from dimstar.session import settled

LENGTH, GRAM = 200, 64
PIECE = 1 << 19
SHARD_SPANS, HOT_SPANS = 1200, 1000
_STORE = 400_000
_U = np.uint64


class Anchors:
    """Spans of a text: gram and span hashes, and the first and last string of each span."""

    def __init__(self) -> None:
        self.gram_hash, self.span_hash = RollingHash(101), RollingHash(202)

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, ...]:
        n = len(data)
        n_strings, width = n - LENGTH + 1, LENGTH - GRAM + 1
        at = np.arange(n - GRAM + 1, dtype=np.int32)
        gram = self.gram_hash.of(self.gram_hash.sums(data), at, at + GRAM)
        # The place of the smallest gram, the last of equal ones, over windows of 2, 4, 8, ...
        best, size = at, 1
        while size < width:
            step = min(size, width - size)
            left, right = best[:-step], best[step:]
            best = np.where(gram[right] <= gram[left], right, left)
            size += step
        lo = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
        hi = np.r_[lo[1:] - 1, n_strings - 1]
        anchor = best[lo]
        span = self.span_hash.of(self.span_hash.sums(data), lo, hi + LENGTH)
        span ^= (anchor - lo).astype(_U) * _U(0x9E3779B97F4A7C15)
        return gram[anchor], span, lo, hi

    def spans(self, data: bytes) -> tuple[np.ndarray, ...]:
        """gram, span (hashes), lo, hi (starts of the first and the last string)."""
        text = np.frombuffer(data, np.uint8)
        parts = []
        for start in range(0, len(text) - LENGTH + 1, PIECE):
            gram, span, lo, hi = self._piece(text[start : start + PIECE + LENGTH - 1])
            parts.append((gram, span, lo + start, hi + start))
        if not parts:
            none = np.zeros(0, np.int64)
            return none.astype(_U), none.astype(_U), none, none
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places in the order of the suffixes that begin there."""
    n = len(data)
    # Seven bytes of nine bits each, so that a zero byte differs from the end.
    padded = np.r_[data.astype(np.int64) + 1, np.zeros(7, np.int64)]
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | padded[k : k + n]
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
    rank = np.zeros(n + 1, np.int64)  # of the group a place is in; 0 beyond the end
    rank[order] = np.cumsum(new)
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, n])
    height = 7
    slots = np.flatnonzero(np.repeat(size, size) > 1)  # slots of groups that are not told apart
    rank[order] = np.repeat(first, size) + 1
    while len(slots):
        places = order[slots]
        group = rank[places]
        following = rank[np.minimum(places + height, n)]
        by = np.argsort(group * (n + 1) + following)
        places, group, following = places[by], group[by], following[by]
        order[slots] = places
        new = np.r_[True, (group[1:] != group[:-1]) | (following[1:] != following[:-1])]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(slots)])
        rank[places] = slots[np.repeat(first, size)] + 1
        slots = slots[np.repeat(size, size) > 1]
        height *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, starts: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """For each place the common prefix with the suffix sorted before it, at most ``most``.

    By Kasai's rule, going through the text the prefix loses one byte at most from place to
    place. Texts that begin at ``starts`` are gone through side by side.
    """
    n = len(data)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    padded = np.r_[data, np.zeros(most + 8, np.uint8)].astype(_U)
    eight = np.zeros(n + most, _U)
    for k in range(8):
        eight = (eight << _U(8)) | padded[k : k + n + most]
    stops = np.r_[starts[1:], n]
    by_size = np.argsort(starts - stops, kind="stable")
    starts, stops = starts[by_size], stops[by_size]
    sizes = stops - starts
    held = np.zeros(len(starts), np.int64)
    out = np.zeros(n, np.int64)
    for k in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -k, side="left"))
        place = starts[:live] + k
        other = before[place]
        h = np.maximum(held[:live] - 1, 0)
        h[other < 0] = 0
        going = np.flatnonzero((other >= 0) & (h < most))
        while len(going):
            a, b = place[going] + h[going], other[going] + h[going]
            differ = eight[a] ^ eight[np.minimum(b, n + most - 1)]
            same = np.where(differ == 0, 8, 0)
            some = np.flatnonzero(differ)
            if len(some):  # equal leading bytes of the eight
                x, bytes_ = differ[some], np.zeros(len(some), np.int64)
                for shift in range(56, 0, -8):
                    bytes_ += (x >> _U(shift)) == 0
                same[some] = bytes_
            h[going] = np.minimum(h[going] + same, most)
            going = going[(same == 8) & (h[going] < most)]
        out[place] = held[:live] = h
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true flags."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _shard(table: pa.Table) -> pa.Table:
    """Of the spans of a shard: gram, span, first, last (strings that occur again, by their
    place in the span); of spans of dealt grams also, by range, their strings for the merge."""
    grams, spans = table.column("gram").to_numpy(), table.column("span").to_numpy()
    dealt = table.column("parts").to_numpy()
    texts = [x.as_py() for x in table.column("data")]
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    order = suffix_array(data)
    prefix = common_prefixes(data, order, starts)[order]
    # Between two whole strings of spans the common prefix is the least on the way in the order.
    whole = np.arange(len(data)) <= np.repeat(starts + sizes - 1 - LENGTH, sizes)
    at = np.flatnonzero(whole[order])
    again = np.zeros(len(data), bool)
    if len(at) > 1:
        shared = np.minimum.reduceat(prefix[: at[-1] + 1], at[:-1] + 1)
        long = np.flatnonzero(shared >= LENGTH)
        again[order[at[long]]] = True
        again[order[at[long + 1]]] = True
    out: dict[str, list] = {k: [] for k in ("gram", "span", "first", "last", "range", "strings", "places")}
    own = RollingHash(303), RollingHash(404)
    for i, start in enumerate(starts):
        n_strings = sizes[i] - LENGTH
        flags = again[start : start + n_strings]
        for a, b in zip(*_runs(flags), strict=True):
            for name, value in zip(out, (grams[i], spans[i], a, b, None, None, None), strict=True):
                out[name].append(value)
        if dealt[i] > 1:
            text = data[start : start + sizes[i] - 1]
            at = np.arange(n_strings)
            x, y = (h.of(h.sums(text), at, at + LENGTH) for h in own)
            name = np.where(flags, _U(1), _U(0))
            by = np.argsort(x)
            borders = np.arange(1, dealt[i], dtype=_U) * _U((1 << 64) // int(dealt[i]))
            cuts = np.r_[0, np.searchsorted(x[by], borders), len(by)]
            for r in range(int(dealt[i])):
                part = by[cuts[r] : cuts[r + 1]]
                if len(part):
                    pairs = np.stack([x[part], y[part]], axis=1).ravel().view(np.int64)
                    codes = (part * 2 + name[part].astype(np.int64)).astype(np.int64)
                    for column, value in zip(out, (grams[i], spans[i], None, None, r, pairs, codes), strict=True):
                        out[column].append(value)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.table({k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds, strict=True)})


def _merged(table: pa.Table) -> pa.Table:
    """Strings of one range of a dealt gram that several lists hold: gram, span, first, last."""
    lists = [np.asarray(x.values).view(_U).reshape(-1, 2) for x in table.column("strings").combine_chunks()]
    codes = [np.asarray(x.values) for x in table.column("places").combine_chunks()]
    pair = np.dtype([("x", _U), ("y", _U)])
    everything = np.concatenate(lists).copy().view(pair).ravel()
    everything.sort(order=["x", "y"])
    grams, spans = table.column("gram").to_numpy(), table.column("span").to_numpy()
    found: list[tuple] = []
    for i, (strings, code) in enumerate(zip(lists, codes, strict=True)):
        unsettled = np.flatnonzero((code & 1) == 0)
        own = strings[unsettled].copy().view(pair).ravel()
        lo = np.searchsorted(everything["x"], own["x"], "left")
        hi = np.searchsorted(everything["x"], own["x"], "right")
        for k in np.flatnonzero(hi - lo > 1):
            if (everything["y"][lo[k] : hi[k]] == own["y"][k]).sum() > 1:
                place = int(code[unsettled[k]] >> 1)
                found.append((grams[i], spans[i], place, place))
    columns = list(zip(*found, strict=True)) or [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    names = ["gram", "span", "first", "last"]
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)})


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("h"),
        F.octet_length(text).cast("long").alias("n"),
    )


def anchored(rows: DataFrame) -> DataFrame:
    """One row per text and task: h, n, spans (gram, span, lo, hi)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, met = Anchors(), set()
        for batch in batches:
            keep, columns = [], ([], [], [], [])
            keys = zip(batch.column("h").to_pylist(), batch.column("n").to_pylist(), strict=True)
            for i, key in enumerate(keys):
                if key[1] < LENGTH or key in met:
                    continue
                if len(met) > _STORE:
                    met.clear()
                met.add(key)
                gram, span, lo, hi = anchors.spans(batch.column("text")[i].as_py().encode("utf-8", "surrogatepass"))
                keep.append(i)
                for column, x in zip(columns, (gram.view(np.int64), span.view(np.int64), lo, hi), strict=True):
                    column.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            sizes = np.cumsum([0] + [len(x) for x in columns[0]]).astype(np.int32)
            flat = [np.concatenate([np.zeros(0, np.int64), *c]) for c in columns]
            fields = pa.StructArray.from_arrays(
                [pa.array(x, k) for x, k in zip(flat, kinds, strict=True)], ["gram", "span", "lo", "hi"]
            )
            spans = pa.ListArray.from_arrays(pa.array(sizes), fields)
            picked = batch.select(["h", "n"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*picked.columns, spans], ["h", "n", "spans"])

    return rows.select("text", "h", "n").mapInArrow(
        run, "h long, n long, spans array<struct<gram:long,span:long,lo:int,hi:int>>"
    )


def _span_texts(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """The bytes of the spans in ``asked`` (h, n, gram, span, parts, shard, lo, hi)."""
    per_text = settled(
        asked.groupBy("h", "n").agg(
            F.collect_list(F.struct("gram", "span", "parts", "shard", "lo", "hi")).alias("asked")
        )
    )
    texts = hits(rows.select("h", "n", "text"), filter_of(per_text.select("h"))).dropDuplicates(["h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "span", "parts", "shard"]
        for batch in batches:
            for i in range(len(batch)):
                data = batch.column("text")[i].as_py().encode("utf-8", "surrogatepass")
                asked = pa.RecordBatch.from_struct_array(batch.column("asked")[i].values)
                lo, hi = asked.column("lo").to_numpy(), asked.column("hi").to_numpy()
                texts = [data[a : b + LENGTH] for a, b in zip(lo, hi, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [asked.column(c) for c in names] + [pa.array(texts, pa.binary())], [*names, "data"]
                )

    return texts.join(per_text, ["h", "n"]).select("text", "asked").mapInArrow(
        run, "gram long, span long, parts int, shard long, data binary"
    )


def contested_strings(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """From the occurrences of contested grams: gram, span, runs of strings that occur again."""
    copies = settled(
        repeated.where("contested")
        .groupBy("gram", "span")
        .agg(
            F.count("*").alias("copies"),
            F.min("h").alias("h"),
            *[F.min_by(c, "h").alias(c) for c in ("n", "lo", "hi")],
        )
    )
    whole = copies.where("copies > 1").select(
        "gram", "span", F.lit(0).alias("first"), (F.col("hi") - F.col("lo")).alias("last")
    )
    # A gram all of whose spans have copies is settled: each string has a twin in one.
    open_ = settled(
        copies.groupBy("gram")
        .agg(F.min("copies").alias("fewest"), F.count("*").alias("spans"))
        .where("fewest = 1")
        .select("gram", F.ceil(F.col("spans") / HOT_SPANS).cast("int").alias("parts"))
    )
    asked = settled(copies.join(open_, "gram"))
    n_shards = -(-asked.count() // SHARD_SPANS) or 1
    shard = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("gram"), F.lit(n_shards))).otherwise(
        F.xxhash64("gram", F.pmod(F.xxhash64("span"), F.col("parts")))
    )
    dealt = _span_texts(rows, asked.withColumn("shard", shard))
    judged = settled(
        dealt.groupBy("shard").applyInArrow(
            _shard,
            "gram long, span long, first int, last int, range int, strings array<long>, places array<long>",
        )
    )
    local = judged.where("first is not null").select("gram", "span", "first", "last")
    across = (
        judged.where("range is not null")
        .select("gram", "range", "span", "strings", "places")
        .groupBy("gram", "range")
        .applyInArrow(_merged, "gram long, span long, first int, last int")
    )
    # A span with copies is whole already; runs found in it besides do no harm.
    runs = local.unionByName(across).unionByName(whole)
    return runs.groupBy("gram", "span").agg(F.collect_list(F.struct("first", "last")).alias("runs"))


def removed_spans(rows: DataFrame) -> DataFrame:
    """h, n, cuts: the spans of bytes each text with repeated strings loses, ordered."""
    held = settled(anchored(rows))
    spans = held.select("h", "n", F.inline("spans"))
    grams = settled(
        spans.groupBy("gram")
        .agg(F.min("span").alias("a"), F.max("span").alias("b"), F.count("*").alias("times"))
        .where("times > 1")
        .select("gram", (F.col("a") != F.col("b")).alias("contested"))
    )
    repeated = settled(spans.join(grams, "gram").select("h", "n", "gram", "span", "lo", "hi", "contested"))
    runs = settled(contested_strings(rows, repeated))
    agreed = repeated.where("not contested").select("h", "n", "lo", (F.col("hi") + LENGTH).alias("stop"))
    argued = (
        repeated.where("contested")
        .join(runs, ["gram", "span"])
        .select("h", "n", "lo", F.inline("runs"))
        .select(
            "h", "n", (F.col("lo") + F.col("first")).alias("lo"),
            (F.col("lo") + F.col("last") + LENGTH).alias("stop"),
        )
    )
    copied = (
        rows.where(F.col("n") >= LENGTH).groupBy("h", "n").agg(F.count("*").alias("times")).where("times > 1")
    ).select("h", "n", F.lit(0).alias("lo"), F.col("n").cast("int").alias("stop"))
    cuts = agreed.unionByName(argued).unionByName(copied)
    return cuts.groupBy("h", "n").agg(F.sort_array(F.collect_set(F.struct("lo", "stop"))).alias("cuts"))


def united(cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ordered spans with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for lo, stop in cuts:
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((lo, stop))
    return out


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, removed (spans of bytes), kept (bytes), kept_sha256."""
    rows = _rows(docs, id_column, text_column)
    cuts = settled(removed_spans(rows))
    told = filter_of(cuts.select("h"))
    touched = hits(rows, told).join(cuts, ["h", "n"], "left")
    others = hits(rows, told, inverted=True).withColumn("cuts", F.lit(None).cast("array<struct<lo:int,stop:int>>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept, digests = [], [], []
            for text, cut in zip(batch.column("text"), batch.column("cuts"), strict=True):
                data = text.as_py().encode("utf-8", "surrogatepass")
                spans = united([(c["lo"], c["stop"]) for c in cut.as_py() or ()])
                ends = [0, *[x for span in spans for x in span], len(data)]
                left = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                removed.append([{"start": a, "stop": b} for a, b in spans])
                kept.append(left)
                digests.append(hashlib.sha256(left).hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n"), pa.array(removed, kind), pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
                ["doc_id", "n_bytes", "removed", "kept", "kept_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, removed array<struct<start:int,stop:int>>, kept binary, kept_sha256 string"
    names = ["doc_id", "n", "text", "cuts"]
    return touched.select(names).mapInArrow(run, schema).unionByName(others.select(names).mapInArrow(run, schema))
