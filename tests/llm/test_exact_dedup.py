import hashlib
from collections import defaultdict

from dimstar.llm.exact_dedup import deduplicated, exact_dedup
from tests.llm.shapes import empty_documents, odd_documents


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[-1], len(ids), k == len(ids) - 1, digest) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def test_groups_as_by_brute_force(spark):
    docs = odd_documents(spark)
    got = sorted([tuple(r) for r in exact_dedup(docs, prefix_chars=4).collect()], key=str)
    assert got == brute(docs.collect())


def test_one_row_of_each_text_stays_with_its_columns(spark):
    docs = odd_documents(spark)
    left = deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted(left.toPandas()["text"].fillna("")) == sorted({r["text"] or "" for r in docs.collect()})


def test_many_rows_of_one_id_and_text(spark):
    docs = spark.range(70_000).selectExpr("5L AS doc_id", "'same' AS text")
    got = exact_dedup(docs).groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in got} == {True: 1, False: 69_999}


def test_empty_table(spark):
    assert exact_dedup(empty_documents(spark)).count() == 0
    assert deduplicated(empty_documents(spark)).count() == 0
