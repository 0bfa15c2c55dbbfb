import hashlib
import zlib

import pytest

from dimstar.llm.merkle import manifest
from tests.llm.shapes import empty_documents, odd_documents


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def code(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, n_chars):
    return H("".join(code(v) for v in (r["doc_id"], r["source"], r["lang"], n_chars, r["text"])))


def tree(nodes):
    """Levels of the tree, level by level, as the rule states it."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([H("".join(row[i:i + 2])) for i in range(0, len(row), 2)])
    return levels


def path(levels, i):
    """(sibling hash or None, sibling on the left) per level from the bottom."""
    out = []
    for row in levels[:-1]:
        j = i ^ 1
        out.append((row[j], j < i) if j < len(row) else (None, False))
        i //= 2
    return out


def fold(h, steps):
    for sib, left in steps:
        h = H(h) if sib is None else H(sib + h) if left else H(h + sib)
    return h


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    per = {}
    for g in order:
        members = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["n_chars"])))
        per[g] = (members, tree([leaf(r, r["n_chars"]) for r in members]))
    top = tree([per[g][1][-1][0] for g in order])
    root = top[-1][0]
    out = []
    for gi, g in enumerate(order):
        members, levels = per[g]
        for i, r in enumerate(members):
            steps = path(levels, i) + path(top, gi)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            n = r["n_chars"] + 1 if hit and r["n_chars"] is not None else r["n_chars"]
            folded = fold(leaf(r, n), steps)
            proof = H("".join(s for s, _ in steps if s is not None))
            out.append((r["doc_id"], leaf(r, r["n_chars"]), levels[-1][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_odd_rows_as_by_brute_force(spark, bits):
    docs = odd_documents(spark)
    got = rows_of(manifest(docs, "lang", bits))
    assert got == brute(docs.collect())


def test_many_rows_several_rounds(spark):
    docs = spark.range(300).selectExpr(
        "id * 7 AS doc_id", "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('t', id) END AS text",
        "CASE id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN NULL ELSE 'é' END AS lang",
        "'s' AS source", "id AS n_chars",
    )
    got = rows_of(manifest(docs, "lang", 2))
    want = brute(docs.collect())
    assert got == want
    # tampered rows fail, the others verify
    assert {r[0] for r in got if not r[6]} == {
        r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
    }


def test_single_row_is_its_own_root(spark):
    docs = odd_documents(spark).where("doc_id = 7")
    (r,) = manifest(docs).collect()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == H("")


def test_empty_table(spark):
    assert manifest(empty_documents(spark)).count() == 0
