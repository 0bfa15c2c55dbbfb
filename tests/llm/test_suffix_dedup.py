import hashlib
import random
from collections import Counter

import numpy as np

from dimstar.llm import suffix_dedup
from dimstar.llm.suffix_dedup import LENGTH, common_prefixes, deduplicated, suffix_array
from tests.llm.shapes import empty_documents, odd_documents


def brute(texts):
    counts = Counter(t[k : k + LENGTH] for t in texts for k in range(len(t) - LENGTH + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - LENGTH + 1):
            if counts[t[k : k + LENGTH]] > 1:
                gone[k : k + LENGTH] = b"\1" * LENGTH
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(docs):
    got = deduplicated(docs).collect()
    return sorted(
        (r["n_bytes"], sum(s["stop"] - s["start"] for s in r["removed"]), len(r["removed"]), r["kept_sha256"]) for r in got
    )


def spliced_texts(seed, n=60):
    """Texts of pieces that others have as well, with cuts, edits, repeats and zero bytes."""
    rng = random.Random(seed)
    letters = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    pool = [letters(rng.choice([199, 200, 201, 350, 900]), rng.choice(["ab", "abcdefgh é\0"])) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            piece = rng.choice(pool)
            if rng.random() < 0.4:
                at = rng.randrange(len(piece))
                piece = piece[:at] + rng.choice("xyz") + piece[at + 1 :]
            if rng.random() < 0.3:
                piece = piece[rng.randrange(60) :]
            parts += [piece, letters(rng.randint(0, 30), "mnop")]
        out.append("".join(parts))
    return [*out, "La " * 200, "La " * 90, "z" * 199, "z" * 200, "y" * 201]


def test_bytes_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_SPANS", 20)
    monkeypatch.setattr(suffix_dedup, "HOT_SPANS", 3)
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    for seed in (1, 2):
        texts = spliced_texts(seed)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        assert run(docs) == brute([t.encode() for t in texts])


def test_suffixes_and_common_prefixes():
    rng = np.random.default_rng(1)
    for n, letters in ((1, 1), (400, 2), (1500, 3), (900, 200)):
        data = rng.integers(1, 1 + letters, n).astype(np.uint8)
        if n > 1000:
            data[900:1400] = data[100:600]
        raw = bytes(data)
        order = suffix_array(data)
        assert [raw[p:] for p in order] == sorted(raw[p:] for p in range(n))
        starts = np.unique([0, n // 3, n // 2])
        prefix = common_prefixes(data, order, starts)
        for before, place in zip(order[:-1], order[1:], strict=True):
            most = min(LENGTH, n - place, n - before)
            same = next((h for h in range(most) if raw[place + h] != raw[before + h]), most)
            assert prefix[place] == same


def test_odd_rows(spark):
    docs = odd_documents(spark)
    texts = [(r["text"] or "").encode() for r in docs.collect()]
    assert run(docs) == brute(texts)
    assert deduplicated(empty_documents(spark)).count() == 0


def test_many_copies_of_a_long_text(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('abc def ', 40) AS text")
    got = deduplicated(docs).selectExpr("sum(length(kept)) AS kept", "count(*) AS n").first()
    assert (got["kept"], got["n"]) == (0, 2000)
