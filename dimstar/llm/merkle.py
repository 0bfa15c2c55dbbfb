"""Merkle manifest of a dataset: leaves, per-group subroots, one root, and a proof per row.

Method: incremental witnesses. Leaves are placed by ``running`` (no task holds a
whole group) and dealt into aligned blocks of ``2**BLOCK_BITS`` positions. Inside a
block the leaves are appended in order to a stack of open subtrees; every appended
node carries a partial witness, and when a later sibling completes a subtree, the
witnesses of all leaves under the left part are extended by it (and those under the
right part by the left one). The roots of the blocks are then treated as further
appends one level up, by the same code on the same blocks, until one node per group
remains; group roots are appended in group order in the same way. Each row's full
witness is its block witness followed by the witness of its block, and of its group,
one level after another.

Hashes: ``H(x)`` is the lowercase hex SHA-256 of the UTF-8 text ``x``; children are
joined as hex text. At every level two consecutive nodes become ``H(left + right)``;
a last node without a partner becomes ``H(node)``; a single node is not hashed again.

Edge cases, all with a defined result:

* A NULL field of a leaf is ``-``; a NULL group sorts first; NULL ``doc_id`` sorts
  first in its group and is never tampered (it has no decimal form).
* Repeated rows give equal leaves in consecutive places; which of them is first
  changes no output row, as both rows are equal up to their place.
* Empty and very long texts are hashed whole by Spark's ``sha2``.
* An empty table gives an empty result.
* Extra columns of the input are ignored; the output has only its own columns.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimstar.operators.skew import running
from dimstar.session import settled

BLOCK_BITS = 10  # 1,024 positions per block: one task holds at most that many nodes
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def field_code(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, ``:`` and the value as text."""
    as_text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(as_text).cast("string"), F.lit(":"), as_text)
    )


def leaf_of(cols: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field_code(cols[f]) for f in FIELDS]), 256)


def tampered(docs: DataFrame) -> Column:
    """``n_chars + 1`` where 7 divides the unsigned crc32 of the decimal ``doc_id``."""
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7) == 0
    return F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))


def _levels(count: int) -> int:
    """Levels above ``count`` nodes until one remains: 0 for one node."""
    return max(count - 1, 0).bit_length()


def _block_witnesses(hashes: list[str], levels: int) -> tuple[str, list[list[str]]]:
    """The block's top node and each node's witness, by appending nodes in order.

    A witness token is ``L<hex>`` (sibling on the left), ``R<hex>`` (on the right) or
    ``-`` (no partner: the node was hashed alone). ``levels`` bounds the height, so the
    last, partial block of a group and a group smaller than a block stop where the
    group's tree does.
    """
    witnesses: list[list[str]] = [[] for _ in hashes]
    # open subtrees: (height, hash, first member, last member + 1)
    stack: list[tuple[int, str, int, int]] = []
    for i, h in enumerate(hashes):
        stack.append((0, h, i, i + 1))
        while len(stack) > 1 and stack[-1][0] == stack[-2][0] and stack[-1][0] < levels:
            height, right, r0, r1 = stack.pop()
            _, left, l0, _ = stack.pop()
            for j in range(l0, r0):
                witnesses[j].append("R" + right)
            for j in range(r0, r1):
                witnesses[j].append("L" + left)
            stack.append((height + 1, _sha(left + right), l0, r1))
    # close the right edge: from the lowest open subtree, a lone node is hashed alone
    # until it meets the height of the subtree to its left, then joins it.
    while stack and (len(stack) > 1 or stack[0][0] < levels):
        height, right, r0, r1 = stack.pop()
        if stack and stack[-1][0] == height:
            _, left, l0, _ = stack.pop()
            for j in range(l0, r0):
                witnesses[j].append("R" + right)
            for j in range(r0, r1):
                witnesses[j].append("L" + left)
            stack.append((height + 1, _sha(left + right), l0, r1))
        else:
            for j in range(r0, r1):
                witnesses[j].append("-")
            stack.append((height + 1, _sha(right), r0, r1))
    return stack[0][1], witnesses


def fold(start: str, tokens: list[str]) -> str:
    """The root reached from ``start`` along a witness."""
    h = start
    for t in tokens:
        if t == "-":
            h = _sha(h)
        elif t[0] == "L":
            h = _sha(t[1:] + h)
        else:
            h = _sha(h + t[1:])
    return h


def _tokens(text: str | None) -> list[str]:
    return [t for t in (text or "").split(" ") if t]


def _height(count: int, bits: int) -> int:
    """Levels a block handles when its group has ``count`` nodes in this round."""
    return min(bits, _levels(count))


NODE_SCHEMA = "g string, pos long, h string, n long"


def _block_roots(nodes: DataFrame, bits: int) -> DataFrame:
    """One node per (group, block): the blocks' tops, the nodes of the next round."""

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        n = int(pdf["n"].iloc[0])
        root, _ = _block_witnesses(list(pdf["h"]), _height(n, bits))
        return pd.DataFrame(
            {"g": [pdf["g"].iloc[0]], "pos": [int(pdf["pos"].iloc[0]) >> bits],
             "h": [root], "n": [(n + (1 << bits) - 1) >> bits]}
        )

    return nodes.groupBy("g", F.shiftright("pos", bits)).applyInPandas(top, NODE_SCHEMA)


def _with_witness(nodes: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """Each node's witness inside its block followed by its block's witness ``above``."""

    def extend(block: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        n = int(block["n"].iloc[0])
        _, inner = _block_witnesses(list(block["h"]), _height(n, bits))
        rest = _tokens(upper["w"].iloc[0]) if len(upper) else []
        return pd.DataFrame(
            {"g": block["g"], "pos": block["pos"], "w": [" ".join(w + rest) for w in inner]}
        )

    keyed = nodes.withColumn("block", F.shiftright("pos", bits))
    return (
        keyed.groupBy("g", "block")
        .cogroup(above.withColumnRenamed("pos", "block").groupBy("g", "block"))
        .applyInPandas(extend, "g string, pos long, w string")
    )


def witnesses(nodes: DataFrame, bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame]:
    """Witness of every node of every group, and each group's root.

    ``nodes``: g (group key as text), pos (0 to n-1 inside the group), h, n (group size).
    Each round's nodes are written to the shared folder, so a lost executor recomputes
    one round only.
    """
    nodes = settled(nodes)
    widest = nodes.agg(F.max("n")).first()[0]
    if widest is None:
        none = nodes.filter(F.lit(False))
        return none.select("g", "pos", F.lit("").alias("w")), none.select("g", F.col("h").alias("root"))
    if widest <= (1 << bits):
        tops = _block_roots(nodes, bits)
        above = tops.select("g", "pos", F.lit("").alias("w"))
        return _with_witness(nodes, above, bits), tops.select("g", F.col("h").alias("root"))
    tops = _block_roots(nodes, bits)
    above, roots = witnesses(tops, bits)
    return _with_witness(nodes, settled(above), bits), roots


def _leaf_rows(placed: DataFrame, above: DataFrame, root: str, bits: int) -> DataFrame:
    """Final rows: each leaf's block witness followed by ``above``'s witness of its block."""

    def finish(block: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        n = int(block["n"].iloc[0])
        _, inner = _block_witnesses(list(block["leaf"]), _height(n, bits))
        rest = _tokens(upper["w"].iloc[0])
        proof, folded = [], []
        for start, own in zip(block["tampered_leaf"], inner):
            tokens = own + rest
            proof.append(_sha("".join(t[1:] for t in tokens if t != "-")))
            folded.append(fold(start, tokens))
        return pd.DataFrame(
            {"doc_id": block["doc_id"], "leaf": block["leaf"],
             "subroot": upper["subroot"].iloc[0], "proof_sha256": proof, "folded_root": folded}
        )

    return (
        placed.withColumn("block", F.shiftright("pos", bits))
        .select(F.col("doc_id").cast("string"), "leaf", "tampered_leaf", "g", "pos", "n", "block")
        .groupBy("g", "block")
        .cogroup(above.groupBy("g", "block"))
        .applyInPandas(
            finish,
            "doc_id string, leaf string, subroot string, proof_sha256 string, folded_root string",
        )
        .select(
            F.col("doc_id").cast("long"), "leaf", "subroot", F.lit(root).alias("root"),
            "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"),
        )
    )


def manifest(docs: DataFrame, group: str = "lang", bits: int = BLOCK_BITS) -> DataFrame:
    """Leaf, subroot, root and proof of every row, with a check of tampered rows.

    Columns: doc_id, leaf, subroot, root, proof_sha256 (H of all sibling hashes from
    the leaf up to the root, left to right), folded_root (the root recomputed from the
    tampered leaf, else the leaf, and the original siblings) and verified.
    Groups (``group``) are ordered NULL first, then by UTF-8 bytes; leaves in a group by
    ``doc_id`` (NULL first), then by leaf. Only the root, one value, reaches the driver.
    """
    cols = {f: F.col(f) for f in FIELDS}
    leaves = docs.select(
        "doc_id",
        leaf_of(cols).alias("leaf"),
        leaf_of(cols | {"n_chars": tampered(docs)}).alias("tampered_leaf"),
        # group key as text that keeps NULL apart from every value and sorts it first
        F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group)))
        .alias("g"),
    )
    placed = settled(
        running(
            leaves, ["g"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")],
            position="_pos", group_rows="n",
        ).withColumn("pos", F.col("_pos") - 1).drop("_pos")
    )
    empty = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, " \
        "folded_root string, verified boolean"
    if placed.agg(F.max("n")).first()[0] is None:
        return docs.sparkSession.createDataFrame([], empty)
    tops = settled(_block_roots(placed.select("g", "pos", F.col("leaf").alias("h"), "n"), bits))
    inside, subroots = witnesses(tops, bits)
    # the group roots in order, appended like leaves of one more tree
    ordered = settled(
        running(
            subroots.withColumn("top", F.lit("")), ["top"], [F.col("g")], position="_p",
            group_rows="n",
        ).select("g", F.col("top"), (F.col("_p") - 1).alias("pos"),
                 F.col("root").alias("subroot"), "n")
    )
    outside, root = witnesses(
        ordered.select(F.col("top").alias("g"), "pos", F.col("subroot").alias("h"), "n"), bits
    )
    root_hash = root.first()["root"]
    by_group = ordered.join(outside.select("pos", F.col("w").alias("w_out")), "pos")
    above = inside.join(by_group.select("g", "subroot", "w_out"), "g").select(
        "g", F.col("pos").alias("block"), "subroot",
        F.concat_ws(" ", "w", "w_out").alias("w"),
    )
    return _leaf_rows(placed, above, root_hash, bits)
