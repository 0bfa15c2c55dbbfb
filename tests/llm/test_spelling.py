import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dimstar.llm import spelling
from dimstar.llm.spelling import variants
from tests.llm.shapes import empty_documents, odd_documents

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 97 == 0:
                    k = h % len(run)
                    run = run[:k] + run[k + 1:]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        r = w
        while form[r] is not None:
            r = form[r]
        f = form[w]
        out.append((w, f, r, words[w], len(near[w]), words[f] if f else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_variants_as_by_brute_force(spark):
    base = ["colour", "color", "colours", "colors", "favour", "favor", "neighbour", "neighbor",
            "thing", "things", "think", "thinks", "cafés", "cafes", "CAFÉS", "Straße", "strasse",
            "abcde", "abcdf", "abxde", "bcde", "abcdef", "aaaaa", "aaaa", "aaaaaa"]
    rows = []
    for i in range(400):
        words = [base[(i * 7 + k * k) % len(base)] for k in range(1 + i % 9)]
        rows.append((i, " ".join(words) + (" colour" * (i % 3)) + (" thing" * (i % 2))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(variants(docs)) == brute(rows)


def test_frequent_grams_are_extended(spark, monkeypatch):
    monkeypatch.setattr(spelling, "FREQUENT", 2)
    rows = [(i, f"station nation ration lotion motion potion notion nations stations {i}") for i in range(6)]
    rows += [(100 + i, "stetion natoin rations") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(variants(docs)) == brute(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(variants(docs)) == brute(rows)
    assert variants(empty_documents(spark)).count() == 0


def test_given_documents_as_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(variants(docs)) == brute(rows)


def test_words_are_listed_under_their_rarest_grams_up_to_two_apart(spark):
    """Of aabbccdd the two rarest grams do not overlap; of xyxyxy it takes four."""
    rows = [("aabbccdd", i, g, f) for i, (g, f) in enumerate(zip(
        ["aabb", "abbc", "bbcc", "bccd", "ccdd", "cdd", "dd"], [1, 9, 9, 9, 2, 9, 9]))]
    rows += [("xyxyxy", i, g, f) for i, (g, f) in enumerate(zip(["xyx", "yxyx", "xyxy", "yxy", "xy"], [3, 1, 2, 9, 9]))]
    chosen = spark.createDataFrame(rows, "word string, i int, gram string, freq long")
    listed = {(r.word, r.i) for r in spelling.rarest_apart(chosen).collect()}
    assert listed == {("aabbccdd", 0), ("aabbccdd", 4), ("xyxyxy", 0), ("xyxyxy", 1), ("xyxyxy", 2), ("xyxyxy", 4)}


def test_words_meet_only_where_the_text_beside_a_listed_gram_agrees(spark):
    """Words of one rare gram at one place, but with other text on both sides, are not verified
    against each other; an edit behind, before or at either end of the gram loses no pair."""
    apart = [(f"{a}{b}wxyz{b}{a}", 2, "wxyz", 1) for a in "abcdefgh" for b in "ijklmnop"]
    near = [("ababwxyzcdcd", 4), ("ababwxyzcdcde", 4), ("bababwxyzcdcd", 5), ("ababwxyzcdd", 4)]
    rows = apart + [(w, i, "wxyz", 1) for w, i in near]
    keys = spelling._in_context(spark.createDataFrame(rows, "word string, i int, gram string, freq long"))
    met = keys.join(keys.withColumnRenamed("word", "b"), "key").where("word < b").select("word", "b").distinct()
    words = [w for w, _ in near]
    want = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    assert len(want) >= 3 and want <= {tuple(r) for r in met.collect()}
    # of the 2,016 pairs of the others none has an equal side
    assert met.where(~F.col("word").isin(words)).count() == 0


def test_tasks_count_runs_before_the_shuffle(spark, monkeypatch):
    """A row for each word and task, also where counts are handed on early; null ids cut nothing."""
    rows = [(i if i % 5 else None, f"Éclair éclair ÉCLAIR straße HOUSE house{i % 3}house a bc def ghij") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert spelling.occurrences(docs).count() < 100
    monkeypatch.setattr(spelling, "_FLUSH", 2)
    assert rows_of(variants(docs)) == brute(rows)
