from dimstar.llm.line_dedup import drop_boilerplate, without_boilerplate
from tests.llm.shapes import empty_documents, odd_documents


def pages(spark):
    rows = [(i, "s", f"own {i}\n  Cookie notice \r\n\nmore {i}") for i in range(8)]
    rows += [(100 + i, "t", "Cookie notice\nkeep") for i in range(2)]  # too few pages
    rows += [(200 + i, None, f"x {i}\nbar") for i in range(5)]
    rows += [(300 + i, "u", "all\nthe same") for i in range(6)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_frequent_lines_go_and_whole_copies_stay(spark):
    got = {r["doc_id"]: r["text"] for r in without_boilerplate(pages(spark), "source").collect()}
    assert got[3] == "own 3\n\nmore 3"
    assert got[100] == "Cookie notice\nkeep"
    assert got[201] == "x 1"
    assert got[300] == "all\nthe same"


def test_counts(spark):
    got = {r["id"]: (r["n_lines"], r["n_dropped"]) for r in drop_boilerplate(pages(spark), "source").selectExpr("row.doc_id AS id", "*").collect()}
    assert got[0] == (4, 1) and got[200] == (2, 1) and got[300] == (2, 0)


def test_ratio_is_exceeded_not_reached(spark):
    rows = [(i, "s", "line" if i < 4 else f"other {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert drop_boilerplate(docs, "source", ratio=0.1).where("n_dropped > 0").count() == 0


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = without_boilerplate(docs, "source", min_pages=2)
    assert got.columns == docs.columns
    assert got.count() == docs.count()
    assert got.where("text is null").count() == docs.where("text is null").count()
    assert without_boilerplate(empty_documents(spark), "source").count() == 0
