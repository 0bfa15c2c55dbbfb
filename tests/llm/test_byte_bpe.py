import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from dimstar.llm.byte_bpe import Encoder, PrefixEncoding, Vocabulary, decoded, encoded, read_ranks, round_trips
from tests.llm.shapes import empty_documents, odd_documents

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(read_ranks(PATH))


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def random_texts(n):
    rng = random.Random(n)
    for _ in range(n):
        yield "".join(rng.choice("aabet  \n\t'sé漢🙂\x1c\x851239.,  ") for _ in range(rng.randint(0, 60)))
    for _ in range(n // 5):
        yield rng.choice(["a", "ab", "the", "hel", "=", "\n"]) * rng.randint(1, 300)


def test_ids_are_those_of_the_library(vocabulary, reference):
    encoder = Encoder(vocabulary, PATTERN)
    texts = list(random_texts(800))
    for text, ids in zip(texts, encoder.in_blocks(texts), strict=True):
        assert ids == reference.encode_ordinary(text), repr(text)
        assert encoder.decode(ids) == text.encode()


def test_appends_and_edits_redo_only_what_is_near(vocabulary):
    rng = random.Random(4)
    letters = lambda n: bytes(rng.choice(b"abcthe ") for _ in range(n))
    for _ in range(150):
        data, more = letters(rng.randint(0, 200)), letters(rng.randint(0, 30))
        grown = PrefixEncoding(vocabulary, data)
        grown.append(more)
        assert grown.last == PrefixEncoding(vocabulary, data + more).last
        i = rng.randint(0, len(data))
        j = rng.randint(i, min(len(data), i + 5))
        edited, new = PrefixEncoding(vocabulary, data), letters(rng.randint(0, 6))
        edited.replace(i, j, new)
        fresh = PrefixEncoding(vocabulary, data[:i] + new + data[j:])
        assert (edited.data, edited.last, edited.tokens()) == (fresh.data, fresh.last, fresh.tokens())
    long = PrefixEncoding(vocabulary, letters(20_000))
    assert long.replace(50, 51, b"x") < 500


def test_documents_round_trip(spark, reference):
    docs = odd_documents(spark)
    got = round_trips(docs, PATH, PATTERN).collect()
    want = []
    for r in docs.collect():
        ids = reference.encode_ordinary(r["text"] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((r["doc_id"], len(ids), digest, hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    tokens = encoded(docs, PATH, PATTERN)
    data = sorted(bytes(r["data"]) for r in decoded(tokens, PATH).collect())
    assert data == sorted((r["text"] or "").encode() for r in docs.collect())


def test_empty_table(spark):
    assert round_trips(empty_documents(spark), PATH, PATTERN).count() == 0
    assert encoded(empty_documents(spark), PATH, PATTERN).count() == 0
