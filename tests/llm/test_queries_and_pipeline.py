"""Registered queries against their SQL, and the pipeline against brute-force stages."""

import hashlib

import duckdb
import public_tokenizers
import tiktoken

import corpus_pipeline
from dimstar.llm import ngram_join
from dimstar.llm.byte_bpe import read_ranks
from dimstar.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.shapes import empty_documents, odd_documents
from tests.llm.test_ngram_join import brute as brute_groups

FOLDER = "/root/testdata/sf0.001"


def test_queries_agree_with_their_sql(spark):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    for name, sql in ORACLE_SQL.items():
        got = QUERIES[name](spark, FOLDER)
        columns = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want), name


def test_thirteen_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id < 20").selectExpr("doc_id + 5000 AS doc_id", "text || ' end' AS text", "lang", "source", "n_chars"))
    docs = docs.unionByName(spark.createDataFrame([(9000, "123 456", "en", "s", 7), (9001, None, None, None, None)], docs.schema))
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        kept.append(docs)
        docs = spark.read.parquet(path)
    columns = kept[0].columns
    assert all(d.columns == columns for d in kept)
    before, lettered, lined, single, mixture = ([tuple(r) for r in d.collect()] for d in kept)
    gone = {r[0] for r in before} - {r[0] for r in lettered}
    assert {9000, 9001} <= gone and len(gone) <= 2 + 0.02 * len(before)
    assert len(lined) == len(lettered)
    like = ngram_join.Similarity(5, 80)
    groups = brute_groups([r[:2] for r in lined], like)
    assert sorted(r[0] for r in single) == sorted({g[2] for g in groups})
    assert {r[0] for r in mixture} <= {r[0] for r in single}
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY)),
        special_tokens={},
    )
    want = []
    for r in mixture:
        ids = library.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in docs.collect()) == sorted(want)


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd_documents(spark), empty_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            assert name == "byte-level BPE" or out.columns == docs.columns
            out.collect()
