"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a byte string has exactly one token its encoding can end with: of all tokens
that end there, the one that may follow the last token of the prefix before it. Storing that
token per prefix gives the encoding by walking back from the end, lets bytes be appended
without encoding anything again, and after an edit only the bytes near it are redone.

Whether one token may follow another is decided by undoing merges on both sides of their
border, the latest first, and looking for a merge across it that would have come before.

A text is cut by the tokenizer's pattern first and each match is encoded by itself. Workers
keep the encodings of short matches they have met; the store is emptied when it is full, so
memory is bounded.

Defined results: a null text counts as empty and has no tokens; no special tokens; text whose
bytes the vocabulary lacks raises an error (byte-level vocabularies have all 256); repeated
rows give repeated rows; ids of documents may be null; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections import ChainMap
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NEVER = -1  # when single bytes came to be: before all merges
_STORE, _STORED_CHARS = 400_000, 48
_PAIRS = 1_000_000
_BLOCK_CHARS = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines with a base64 token and its rank."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


def spaces_as_unicode(pattern: str) -> str:
    r"""``\s`` as the White_Space property, which leaves out the separators U+001C to U+001F."""
    inside = r"\t-\r \x85\xa0  -     　"
    out, in_class, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two in (r"\s", r"\S"):
            negated = two == r"\S"
            out.append((inside if not negated else r"\S") if in_class else f"[{'^' * negated}{inside}]")
            i += 2
        elif two[0] == "\\":
            out.append(two)
            i += 2
        else:
            in_class = two[0] == "[" or in_class and two[0] != "]"
            out.append(two[0])
            i += 1
    return "".join(out)


class Vocabulary:
    """Ranks with what the encoder asks: how a token came to be and which tokens end where."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.ids: dict[bytes, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                pair = self._last_two(token, ranks, rank)
                if pair is None:
                    continue  # no sequence of merges ends in this token
                self.parts[rank] = pair
                self.merged[pair] = rank
            self.ids[token] = rank
        # What tokens end with: the token that it is itself, or -1.
        self.endings = {t[k:]: -1 for t in self.ids for k in range(1, len(t))} | self.ids
        self.follows: dict[int, bool] = {}

    @staticmethod
    def _last_two(token: bytes, ranks: dict[bytes, int], below: int) -> tuple[int, int] | None:
        """The two tokens left when only merges that rank before ``below`` are done."""
        pieces = [token[i : i + 1] for i in range(len(token))]
        while len(pieces) > 2:
            rank, at = min(
                (ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(pieces, pieces[1:], strict=False))
            )
            if rank >= below:
                return None
            pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        return ranks[pieces[0]], ranks[pieces[1]]

    def may_follow(self, left: int, right: int) -> bool:
        """The same as ``_may_follow``; answers are kept, as many as fit."""
        code = left << 32 | right
        known = self.follows.get(code)
        if known is None:
            if len(self.follows) > _PAIRS:
                self.follows.clear()
            known = self.follows[code] = self._may_follow(left, right)
        return known

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are what their bytes encode to."""
        parts, merged = self.parts, self.merged
        before: float = float("inf")  # a merge across the border would have had to rank below
        while True:
            across = merged.get((left, right))
            if across is not None and across < before:
                return False
            made_left = left if left in parts else _NEVER
            made_right = right if right in parts else _NEVER
            if made_left == made_right == _NEVER:
                return True
            # Of equal merges the left one is done first, so it is undone last.
            if made_left > made_right:
                before, left = made_left, parts[left][1]
            else:
                before, right = made_right + 1, parts[right][0]


class PrefixEncoding:
    """The bytes of one match and, for every prefix, the token its encoding ends with."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _last_token(self, end: int) -> int:
        v, data, last = self.vocabulary, self.data, self.last
        known, ending = v.endings.get, []
        for start in range(end - 1, -1, -1):
            token = known(data[start:end])
            if token is None:
                break
            if token >= 0:
                ending.append((start, token))
        for start, token in reversed(ending):
            if start == 0 or v.may_follow(last[start - 1], token):
                return token
        raise ValueError(f"the vocabulary lacks byte {data[end - 1]}")

    def restart(self, data: bytes) -> None:
        """Goes on to other bytes; prefixes that both have in common are kept."""
        same, most = 0, min(len(data), len(self.data))
        while same < most and data[same] == self.data[same]:
            same += 1
        self.data = data[:same]
        del self.last[same:]
        self.append(data[same:])

    def append(self, more: bytes) -> None:
        """Adds bytes at the end; what is stored stays as it is."""
        self.data += more
        for end in range(len(self.last) + 1, len(self.data) + 1):
            self.last.append(self._last_token(end))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Puts ``new`` in the place of bytes start to stop; the number of prefixes redone."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, same, end = old[:start], 0, start
        # A prefix depends on as many before it as the longest token has bytes.
        while end < len(self.data) and same < self.vocabulary.longest:
            self.last.append(self._last_token(end + 1))
            was = end - shift
            kept = was >= stop and self.last[end] == old[was]
            same = same + 1 if kept else 0
            end += 1
        redone = end - start
        self.last += old[end - shift :]
        return redone

    def tokens(self) -> list[int]:
        out, end = [], len(self.last)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes_of[out[-1]])
        return out[::-1]


class Encoder:
    """Whole texts, one pattern match after the other."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.find = regex.compile(spaces_as_unicode(pattern)).findall
        self.stored: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Matches not met before are sorted, so that each shares prefixes with the one before."""
        found = [self.find(text) for text in texts]
        every = set(chain.from_iterable(found))
        stored, once = self.stored, {}
        if len(stored) > _STORE:
            stored.clear()
        encoding, whole = PrefixEncoding(self.vocabulary), self.vocabulary.ids
        for data, match in sorted((m.encode("utf-8"), m) for m in every if m not in stored):
            if data in whole:
                ids = [whole[data]]
            else:
                encoding.restart(data)
                ids = encoding.tokens()
            (stored if len(match) <= _STORED_CHARS else once)[match] = ids
        both = stored if not once else ChainMap(once, stored)
        return [list(chain.from_iterable(map(both.__getitem__, matches))) for matches in found]

    def in_blocks(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The ids of text after text; blocks bound what is held at once."""
        block, held = [], 0
        for text in texts:
            block.append(text or "")
            held += len(block[-1])
            if held > _BLOCK_CHARS:
                yield from self.encode_all(block)
                block, held = [], 0
        yield from self.encode_all(block)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


def _inputs(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))


def _encoders(ranks_path: str, pattern: str):
    """A function that gives a worker its encoder; the vocabulary is read on the driver."""
    vocabulary = Vocabulary(read_ranks(ranks_path))
    return lambda: Encoder(vocabulary, pattern)


def _id_field(docs: DataFrame, id_column: str) -> str:
    return f"doc_id {docs.select(id_column).schema[0].dataType.simpleString()}"


def encoded(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, ids."""
    encoder_of = _encoders(ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of()
        for batch in batches:
            ids = list(encoder.in_blocks(x.as_py() for x in batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    schema = f"{_id_field(docs, id_column)}, ids array<int>"
    return _inputs(docs, id_column, text_column).mapInArrow(run, schema)


def decoded(tokens: DataFrame, ranks_path: str, id_column: str = "doc_id") -> DataFrame:
    """One row per row of (id, ids): doc_id, data (bytes); null ids count as none."""
    shared = tokens.sparkSession.sparkContext.broadcast(
        {rank: token for token, rank in read_ranks(ranks_path).items()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = shared.value
        for batch in batches:
            data = [b"".join(bytes_of[i] for i in x.as_py() or ()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"]
            )

    rows = tokens.select(F.col(id_column).alias("doc_id"), "ids")
    return rows.mapInArrow(run, f"{_id_field(tokens, id_column)}, data binary")


def round_trips(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encodes and decodes in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    encoder_of = _encoders(ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of()
        decimal = {i: str(i) for i in encoder.vocabulary.bytes_of}.__getitem__
        for batch in batches:
            counts, of_ids, of_data = [], [], []
            for ids in encoder.in_blocks(x.as_py() for x in batch.column("text")):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                of_data.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_data, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"{_id_field(docs, id_column)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _inputs(docs, id_column, text_column).mapInArrow(run, schema)
