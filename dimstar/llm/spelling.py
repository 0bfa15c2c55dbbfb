"""Spelling variants: words one edit apart, each pointed to its far more frequent variant.

Method: a variable-length gram index (VGRAM).

1. Words and counts: every maximal run of Latin letters is a word occurrence; tasks
   count the runs of their texts (those long enough to be words) before the shuffle.
2. A frequency-pruned gram dictionary: all grams of ``Q_MIN`` code points are in it;
   a gram shorter than ``Q_MAX`` that occurs more than ``FREQUENT`` times has its
   one-longer extensions in it as well, so frequent grams give way to rarer, longer ones.
3. Every word is decomposed into variable grams: at each position the longest gram of
   the dictionary that starts there.
4. Per-word affected-gram bound: one edit at a position changes at most the grams that
   start in the ``Q_MAX`` positions up to it, so a word ``s`` with ``|G(s)|`` grams keeps
   at least ``|G(s)| - NAG(s)`` of them in any word one edit away, where ``NAG(s)`` is the
   largest number of its grams that start in one such window.
5. Inverted lists with that bound: a word one edit away must hold at least one of any
   ``NAG(s) + 1`` of ``s``'s grams, and one of any two that do not overlap. So each word
   is listed under its rarest grams only, up to the first two that do not overlap
   (``NAG(s) + 1`` at most); what comes before the rarest gram that both words keep is
   changed by the one edit, so that gram is listed for both. A kept gram lies wholly
   before or wholly behind the edit, so the words agree in all that comes up to its end,
   or in all from its start on: lists are cut by that text, and words that meet in one
   are verified by Spark's ``levenshtein`` with a threshold of 1.
6. Words whose bound is 0 (too short for the count filter) are handled exactly by
   deletion neighbourhoods: a word and every copy of it with one code point deleted,
   joined against the same keys of all words, then verified alike.

Links are made symmetric. A word's form is its near word of largest count (ties: the
smallest word in code-point order) if that count is at least twice its own, and its
root follows forms to the end by pointer jumping; counts at least double along a
chain, so a chain has fewer links than the bits of the largest count.

Edge cases: NULL texts have no runs; NULL ``doc_id`` makes the hash NULL, so no code
point is deleted; repeated rows count again (occurrences are counted over all rows);
an empty table or one without qualifying words gives an empty result; extra input
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimstar.session import settled

MIN_CHARS = 5
MIN_COUNT = 3
DELETE_MOD = 97
Q_MIN = 2
Q_MAX = 4
FREQUENT = 64  # a gram in more words than this is extended, up to Q_MAX
SHORT = Q_MAX + Q_MIN - 1  # the longest word whose count bound can be 0
RUN = rf"[a-z\u00C0-\u00FF]{{{MIN_CHARS},}}"  # of lower-cased texts; shorter runs are no words
_FLUSH = 400_000


def occurrences(docs: DataFrame) -> DataFrame:
    """word, n: runs of MIN_CHARS code points at least, lower-cased, with one code point deleted
    where 97 divides h; a row for each word and task, or more where a task holds very many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = re.compile(RUN).findall, Counter()

        def emitted() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                # bytes lower-case A-Z only
                runs = find(text.as_py().lower().decode("utf-8", "replace"))
                counts.update(runs)
                if doc_id is not None:
                    before = zlib.crc32(f"{doc_id}:".encode())
                    for word in set(runs):
                        h = zlib.crc32(word.encode(), before)
                        if h % DELETE_MOD == 0:
                            n, at = runs.count(word), h % len(word)
                            counts[word] -= n
                            counts[word[:at] + word[at + 1 :]] += n
                if len(counts) > _FLUSH:
                    yield emitted()
        yield emitted()

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text.alias("text"))
    return texts.mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n for words of at least MIN_CHARS code points seen at least MIN_COUNT times."""
    counted = occurrences(docs).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.char_length("word") >= MIN_CHARS) & (F.col("n") >= MIN_COUNT))


def _all_grams(words: DataFrame) -> DataFrame:
    """Every substring of Q_MIN to Q_MAX code points with its start (0-based) and length."""
    starts = F.sequence(F.lit(0), F.char_length("word") - Q_MIN)
    placed = words.select("word", F.explode(starts).alias("i"))
    sized = placed.select(
        "word", "i", F.explode(F.sequence(F.lit(Q_MIN), F.lit(Q_MAX))).alias("q")
    ).where(F.col("i") + F.col("q") <= F.char_length("word"))
    return sized.withColumn("gram", F.expr("substring(word, i + 1, q)"))


def dictionary(grams: DataFrame) -> DataFrame:
    """The frequency-pruned dictionary: gram, q and its frequency (words holding it)."""
    freq = grams.groupBy("gram", "q").agg(F.countDistinct("word").alias("freq"))
    freq = settled(freq)
    kept = freq.where(F.col("q") == Q_MIN)
    level = kept
    for q in range(Q_MIN + 1, Q_MAX + 1):
        parents = level.where(F.col("freq") > FREQUENT).select(F.col("gram").alias("parent"))
        level = (
            freq.where(F.col("q") == q)
            .withColumn("parent", F.expr(f"substring(gram, 1, {q - 1})"))
            .join(parents, "parent", "left_semi")
            .drop("parent")
        )
        kept = kept.unionByName(level)
    return kept


def decompose(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each word's grams (word, i, gram, freq) and the dictionary."""
    grams = _all_grams(words)  # cheap to derive again: read twice, never written
    found = dictionary(grams)
    matched = grams.join(found, ["gram", "q"])
    longest = Window.partitionBy("word", "i").orderBy(F.col("q").desc())  # one word's grams
    chosen = matched.withColumn("_r", F.row_number().over(longest)).where("_r = 1").drop("_r")
    return settled(chosen.select("word", "i", "gram", "freq")), found


def bounds(chosen: DataFrame) -> DataFrame:
    """word, size (|G|) and nag: the most grams that start in Q_MAX positions up to a place.

    Every position with Q_MIN code points left starts exactly one gram (all grams of
    Q_MIN are in the dictionary), so the largest window holds min(Q_MAX, |G|) starts.
    """
    sized = chosen.groupBy("word").agg(F.count(F.lit(1)).alias("size"))
    return sized.withColumn("nag", F.least(F.lit(Q_MAX), F.col("size")))


def rarest_apart(chosen: DataFrame) -> DataFrame:
    """word, gram, i: of each word its rarest grams up to the first two that do not overlap.

    All words order grams alike (frequency, gram, place). One edit cannot change two grams
    that do not overlap: a gram reaches only over its own code points, as one that could be
    longer is longer wherever a code point follows it.
    """
    rarest = Window.partitionBy("word").orderBy("freq", "gram", "i")  # one word's grams
    before = rarest.rowsBetween(Window.unboundedPreceding, -1)
    end = F.min(F.col("i") + F.char_length("gram")).over(before)
    apart = F.max("i").over(before) >= end
    return (
        chosen.withColumn("_apart", F.coalesce(apart, F.lit(False))).where(~F.col("_apart")).select("word", "gram", "i")
    )


def _in_context(listed: DataFrame) -> DataFrame:
    """word, key: a hash of a listed gram's length with the text up to its end, and one with the
    text from its start on. Verification follows, so hashes that clash add no pairs."""
    q = F.char_length("gram")
    before = F.xxhash64(F.lit("<"), q, F.expr("substring(word, 1, i + char_length(gram))"))
    behind = F.xxhash64(F.lit(">"), q, F.expr("substring(word, i + 1)"))
    return listed.select("word", F.explode(F.array(before, behind)).alias("key"))


def _verified(pairs: DataFrame) -> DataFrame:
    close = F.abs(F.char_length("a") - F.char_length("b")) <= 1
    return pairs.where(close & (F.col("a") != F.col("b"))).where(
        F.levenshtein("a", "b", 1) == 1
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs (a, b) of vocabulary words one edit apart, both directions."""
    chosen, _ = decompose(words.select("word"))
    sized = settled(bounds(chosen))
    bounded = sized.where(F.col("size") > F.col("nag")).select("word")
    listed = settled(_in_context(rarest_apart(chosen.join(bounded, "word", "left_semi"))))
    # Both ends of a pair between words with a bound find each other: each pair is
    # verified once (a < b), and duplicates go after the verification, among few rows.
    met = listed.select("key", F.col("word").alias("a")).join(
        listed.select("key", F.col("word").alias("b")), "key"
    )
    by_grams = _verified(met.where(F.col("a") < F.col("b")).select("a", "b")).distinct()
    # the rest: deletion neighbourhoods, exact for one edit
    # a word without a positive bound has |G| <= Q_MAX, so at most SHORT code points;
    # only words one longer than that can be its partners
    short = sized.where(F.col("size") <= F.col("nag")).select("word")
    keys = _deletion_keys(words.where(F.char_length("word") <= SHORT + 1).select("word"))
    by_keys = _verified(
        keys.join(short, "word", "left_semi").select(F.col("word").alias("a"), "key")
        .join(keys.select(F.col("word").alias("b"), "key"), "key")
        .select("a", "b")
    )
    found = by_grams.unionByName(by_keys)
    return found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _deletion_keys(words: DataFrame) -> DataFrame:
    at = F.explode(F.sequence(F.lit(0), F.char_length("word")))
    placed = words.select("word", at.alias("i"))
    key = F.when(F.col("i") == F.char_length("word"), F.col("word")).otherwise(
        F.concat(F.expr("substring(word, 1, i)"), F.expr("substring(word, i + 2)"))
    )
    return placed.select("word", key.alias("key")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word and root by pointer jumping over ``form``; every round is written once."""
    step = settled(forms.select("word", F.coalesce("form", "word").alias("up")))
    while True:
        nxt = settled(
            step.alias("s")
            .join(step.alias("t"), F.col("s.up") == F.col("t.word"))
            .select(F.col("s.word").alias("word"), F.col("t.up").alias("up"))
        )
        moved = nxt.alias("x").join(step.alias("y"), "word").where(F.col("x.up") != F.col("y.up"))
        if moved.isEmpty():
            return nxt.select("word", F.col("up").alias("root"))
        step = nxt


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n for every vocabulary word."""
    words = settled(vocabulary(docs))
    pairs = near_pairs(words)
    counted = pairs.join(words.select(F.col("word").alias("b"), F.col("n").alias("bn")), "b")
    best = counted.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("bn")).alias("neg"), F.col("b").alias("w"))).alias("_best"),
    )
    joined = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    top_n = -F.col("_best.neg")
    strong = top_n >= 2 * F.col("n")
    forms = settled(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("_best.w")).alias("form"),
            F.when(strong, top_n).cast("long").alias("form_n"),
        )
    )
    roots = _roots(forms)
    return forms.join(roots, "word").select(
        "word", "form", "root", F.col("n").cast("long"), "n_near", "form_n"
    )
