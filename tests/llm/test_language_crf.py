import numpy as np
import pytest

from dimstar.llm.language_crf import Labeller, features, identified, identify, learn, marginals, train
from tests.llm.shapes import empty_documents, odd_documents


def sequence_marginals(scores, moves):
    e, step, n = np.exp(scores), np.exp(moves), scores.shape[1]
    ahead, state = [], np.ones(n) / n
    for row in e:
        state = (state @ step) * row
        state /= state.sum()
        ahead.append(state)
    out, back = [None] * len(e), np.ones(n)
    for t in range(len(e) - 1, -1, -1):
        out[t] = ahead[t] * back / (ahead[t] * back).sum()
        back = step @ (e[t] * back)
        back /= back.sum()
    return np.array(out)


def test_chunked_chains_give_what_one_chain_gives():
    rng = np.random.default_rng(0)
    for _ in range(6):
        lengths = rng.integers(1, 40, 7)
        scores, moves = rng.normal(size=(lengths.sum(), 3)) * 2, rng.normal(size=(3, 3))
        got = marginals(scores, lengths, moves, chunk=5)
        for part, own in zip(np.split(got, np.cumsum(lengths)[:-1]), np.split(scores, np.cumsum(lengths)[:-1]), strict=True):
            assert np.allclose(part, sequence_marginals(own, moves))


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    alone = [sorted(features([w])[1].tolist()) for w in ("a", "über", "漢字かな")]
    owner, bucket = features(["a", "über", "漢字かな"])
    assert [sorted(bucket[owner == i].tolist()) for i in range(3)] == alone


def invented(seed, syllables, n):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    return [" ".join(word() for _ in range(40)) for _ in range(n)]


@pytest.fixture(scope="module")
def field():
    rows = [(t, "xx") for t in invented(1, ["th", "ing", "er", "on", "sh"], 60)]
    rows += [(t, "yy") for t in invented(2, ["ü", "cht", "ein", "sch", "en"], 60)]
    return train(rows, max_runs=800)


def test_words_of_switched_text_are_labelled(field):
    words = (invented(9, ["th", "ing", "er", "on", "sh"], 1)[0] + " " + invented(8, ["ü", "cht", "ein", "sch", "en"], 1)[0]).split()
    best = Labeller(field).word_probabilities([words]).argmax(axis=1)
    truth = np.repeat([0, 1], 40)
    assert (best == truth).mean() > 0.95
    shares, switches = Labeller(field).shares([words])
    assert abs(shares[0, 0] - 0.5) < 0.1 and 1 <= switches[0] <= 4
    assert field.moves[0, 0] > field.moves[0, 1]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(got) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in got) > 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark, field):
    docs = odd_documents(spark)
    got = identify(docs, field)
    assert got.select("row.*").columns == docs.columns
    rows = got.selectExpr("row.text AS text", "lang_pred", "score").collect()
    assert len(rows) == docs.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered)
        assert lettered or r["score"] == 0
    assert identified(docs).count() == docs.count()
    assert identified(empty_documents(spark)).count() == 0
    assert learn(empty_documents(spark)) is None
    assert {r["lang_pred"] for r in identify(docs, None).collect()} == {"und"}
