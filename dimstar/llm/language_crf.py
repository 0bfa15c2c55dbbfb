"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a language: emissions come from the word's prefixes, suffixes,
character n-grams and a lexicon learned from the labelled texts, transitions between the
languages of neighbouring words are learned with them, and forward-backward gives each word's
probabilities. A document's language is the one with the largest sum over all its words, its
score that sum over the number of words, so code-switched texts show as low scores.

The field is trained on runs of words cut from labelled documents and spliced, so that it sees
switches. Rows to learn from are bounded: at most about ``docs_per_language`` documents of each
language, chosen by a hash of the id, and ``max_runs`` runs drawn over their whole texts. All
texts to predict are read whole; long ones are cut into chunks whose transfer matrices are
multiplied, which gives the same probabilities as one long chain.

Defined results: ``und`` with score 0 if the text is null or has no letter, or if there was
nothing to learn from; only the text enters a prediction; a null id counts as an empty string
where ids are hashed; repeated rows get equal results; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimstar.session import settled

UND = "und"
DOCS_PER_LANGUAGE, MAX_RUNS, RUN = 300, 6000, 32
_BUCKETS = 1 << 15
_CHUNK = 128
_BATCH_WORDS = 400_000
_STORE = 300_000
_EPOCHS, _BATCH, _RATE = 6, 250, 0.15
_WORDS = re.compile(r"[^\W\d_]+").findall


def _bucket(kind: int, *codes: np.ndarray) -> np.ndarray:
    h = np.full(codes[0].shape, kind, np.uint64)
    for c in codes:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(20)).astype(np.int64) % _BUCKETS


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' affixes, n-grams and spelling, as (number of the word, bucket) pairs."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    # All words in a row, each between two marks: ^word$
    codes = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le"), np.uint32)
    first = np.cumsum(sizes + 2) - sizes - 1
    last = first + sizes - 1
    number = np.arange(len(words))
    of = np.repeat(number, sizes + 2)
    whole = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words))
    owners, buckets = [number], [_bucket(1, whole)]
    for k in (1, 2, 3):
        long = sizes > k
        owners += [number[long]] * 2
        buckets.append(_bucket(10 + k, *[codes[first[long] + i] for i in range(k)]))
        buckets.append(_bucket(20 + k, *[codes[last[long] - i] for i in range(k)]))
    for n in (2, 3):
        inside = of[: len(of) - n + 1] == of[n - 1 :]
        owners.append(of[: len(of) - n + 1][inside])
        buckets.append(_bucket(30 + n, *[codes[i : len(codes) - n + 1 + i][inside] for i in range(n)]))
    return np.concatenate(owners), np.concatenate(buckets)


@dataclass
class Field:
    """What is learned: weights of features and of the lexicon, transitions between labels."""

    labels: list[str]
    weights: np.ndarray  # buckets x labels
    lexicon: dict[str, np.ndarray]  # word: log share of each label
    trust: np.ndarray  # weight of the lexicon for each label
    moves: np.ndarray  # labels x labels, logarithms

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of each word for each label."""
        n = len(self.labels)
        owner, bucket = features(words)
        sums = [np.bincount(owner, self.weights[bucket, k], len(words)) for k in range(n)]
        none = np.zeros(n)
        known = np.array([self.lexicon.get(w, none) for w in words]).reshape(-1, n)
        return np.stack(sums, axis=1) + known * self.trust


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, chunk: int = _CHUNK) -> np.ndarray:
    """Forward-backward over many texts at once: the words' probabilities of each label.

    ``scores`` has the words of all texts one after the other, ``lengths`` is 1 at least. The
    state before a text's first word is uniform.
    """
    n_labels = scores.shape[1]
    step = np.exp(moves - moves.max())
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    n_chunks = -(-lengths // chunk)
    text_of = np.repeat(np.arange(len(lengths)), n_chunks)
    nth = np.arange(len(text_of)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
    begin = np.repeat(np.cumsum(lengths) - lengths, n_chunks) + nth * chunk
    size = np.minimum(chunk, np.repeat(lengths, n_chunks) - nth * chunk)
    order = np.argsort(-size, kind="stable")
    begin, size, nth, text_of = begin[order], size[order], nth[order], text_of[order]
    steps = int(size[0])
    active = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")

    transfer = np.broadcast_to(np.eye(n_labels), (len(size), n_labels, n_labels)).copy()
    for t in range(steps):
        n = active[t]
        moved = (transfer[:n] @ step) * e[begin[:n] + t][:, None, :]
        transfer[:n] = moved / moved.sum(axis=(1, 2), keepdims=True)

    # Messages at the chunks' borders, chunk by chunk of all texts.
    place = np.empty((len(size),), int)
    by_text = np.lexsort((nth, text_of))
    place[by_text] = np.arange(len(size))
    first = np.cumsum(n_chunks) - n_chunks
    before = np.empty((len(size), n_labels))
    after = np.empty((len(size), n_labels))
    longest_first = np.argsort(-n_chunks, kind="stable")
    sorted_chunks = n_chunks[longest_first]
    texts_with = np.searchsorted(-sorted_chunks, -np.arange(1, n_chunks.max() + 1), side="right")
    state = np.full((len(lengths), n_labels), 1.0 / n_labels)
    for k, n in enumerate(texts_with):
        at = by_text[first[longest_first[:n]] + k]
        before[at] = state[:n]
        state[:n] = _normal((state[:n, None, :] @ transfer[at])[:, 0])
    state = np.full((len(lengths), n_labels), 1.0 / n_labels)
    for k in range(len(texts_with) - 1, -1, -1):
        n = texts_with[k]
        at = by_text[first[longest_first[:n]] + k]
        after[at] = state[:n]
        state[:n] = _normal((transfer[at] @ state[:n, :, None])[:, :, 0])

    out = np.empty_like(e)
    for t in range(steps):
        n = active[t]
        at = begin[:n] + t
        before[:n] = _normal((before[:n] @ step) * e[at])
        out[at] = before[:n]
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        out[at] = _normal(out[at] * after[:n])
        after[:n] = _normal((e[at] * after[:n]) @ step.T)
    return out


def _run_gradients(e: np.ndarray, labels: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of equal length (runs x words x labels): what the labels have over what the
    field expects, for words and for moves."""
    runs, words, n = e.shape
    ahead, back = np.empty_like(e), np.empty_like(e)
    state = np.full((runs, n), 1.0 / n)
    for t in range(words):
        state = _normal((state @ step) * e[:, t])
        ahead[:, t] = state
    state = np.ones((runs, n)) / n
    for t in range(words - 1, -1, -1):
        back[:, t] = state
        state = _normal((e[:, t] * state) @ step.T)
    for_words = -_normal(ahead * back)
    np.put_along_axis(
        for_words, labels[:, :, None], np.take_along_axis(for_words, labels[:, :, None], 2) + 1, 2
    )
    pairs = ahead[:, :-1, :, None] * step * (e[:, 1:] * back[:, 1:])[:, :, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    for_moves = -pairs.sum(axis=(0, 1))
    np.add.at(for_moves, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1.0)
    return for_words, for_moves


def _spliced(
    texts: list[list[str]], label_of: list[int], max_runs: int, rng: np.random.Generator
) -> tuple[list[str], np.ndarray]:
    """Runs of RUN words made of pieces of labelled texts, one to three pieces a run."""
    by_label: dict[int, list[int]] = {}
    for i, label in enumerate(label_of):
        by_label.setdefault(label, []).append(i)
    present = sorted(by_label)
    words: list[str] = []
    labels: list[int] = []
    total = sum(map(len, texts))
    for _ in range(min(max_runs, 2 + 4 * total // RUN)):
        n_pieces = int(rng.choice([1, 2, 3], p=[0.5, 0.3, 0.2]))
        cuts = sorted(rng.choice(np.arange(1, RUN), n_pieces - 1, replace=False).tolist())
        for a, b in zip([0, *cuts], [*cuts, RUN], strict=True):
            label = present[int(rng.integers(len(present)))]
            left = b - a
            while left:
                text = texts[by_label[label][int(rng.integers(len(by_label[label])))]]
                at = int(rng.integers(len(text)))
                piece = text[at : at + left]
                words += piece
                labels += [label] * len(piece)
                left -= len(piece)
    return words, np.array(labels).reshape(-1, RUN)


def train(rows: list[tuple[str, str]], max_runs: int = MAX_RUNS, seed: int = 5) -> Field | None:
    """A field from (text, label) rows, which are few; None if there is no word to learn from."""
    read = [(_WORDS(text.lower()), label) for text, label in rows]
    read = [(words, label) for words, label in read if words]
    if not read:
        return None
    labels = sorted({label for _, label in read})
    n = len(labels)
    label_of = [labels.index(label) for _, label in read]
    rng = np.random.default_rng(seed)

    counts = [Counter() for _ in labels]
    for (words, _), label in zip(read, label_of, strict=True):
        counts[label].update(words)
    sums = np.array([max(1, sum(c.values())) for c in counts], float)
    often = sorted(w for w, c in sum(counts, Counter()).items() if c >= 3)
    lexicon = {}
    for word in often:
        rate = (np.array([c[word] for c in counts]) + 0.05) / sums
        lexicon[word] = np.log(_normal(rate))

    run_words, gold = _spliced([w for w, _ in read], label_of, max_runs, rng)
    types = sorted(set(run_words))
    number = {w: i for i, w in enumerate(types)}
    ids = np.array([number[w] for w in run_words]).reshape(gold.shape)
    owner, bucket = features(types)
    known = np.array([lexicon.get(w, np.zeros(n)) for w in types])

    field = Field(labels, np.zeros((_BUCKETS, n)), lexicon, np.full(n, 0.2), np.eye(n) * 2.0)
    seen_w, seen_t, seen_m = np.full_like(field.weights, 1e-3), np.full(n, 1e-3), np.full((n, n), 1e-3)
    for _ in range(_EPOCHS):
        shuffled = rng.permutation(len(ids))
        for at in range(0, len(ids), _BATCH):
            pick = shuffled[at : at + _BATCH]
            scores = known * field.trust
            for k in range(n):
                scores[:, k] += np.bincount(owner, field.weights[bucket, k], len(types))
            e = scores[ids[pick]]
            e = np.exp(e - e.max(axis=2, keepdims=True))
            for_words, for_moves = _run_gradients(e, gold[pick], np.exp(field.moves - field.moves.max()))
            per_type = np.stack(
                [np.bincount(ids[pick].ravel(), for_words[:, :, k].ravel(), len(types)) for k in range(n)], 1
            )
            g = np.stack([np.bincount(bucket, per_type[owner, k], _BUCKETS) for k in range(n)], 1)
            g = g / len(pick) - 1e-4 * field.weights
            seen_w += g * g
            field.weights += _RATE * g / np.sqrt(seen_w)
            g = (per_type * known).sum(axis=0) / len(pick)
            seen_t += g * g
            field.trust += 0.2 * _RATE * g / np.sqrt(seen_t)
            g = for_moves / len(pick)
            seen_m += g * g
            field.moves += _RATE * g / np.sqrt(seen_m)
    return field


class Labeller:
    """Applies a field to batches of texts; keeps the emissions of words it has met."""

    def __init__(self, field: Field):
        self.field = field
        self.ids: dict[str, int] = {}
        self.known = np.zeros((0, len(field.labels)))

    def _scores(self, words: list[str]) -> np.ndarray:
        if len(self.ids) > _STORE:
            self.ids.clear()
            self.known = self.known[:0]
        new = [w for w in set(words) if w not in self.ids]
        if new:
            self.ids.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.known = np.concatenate([self.known, self.field.emissions(new)])
        return self.known[np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))]

    def word_probabilities(self, texts: list[list[str]]) -> np.ndarray:
        words = [w for text in texts for w in text]
        return marginals(self._scores(words), np.array([len(t) for t in texts]), self.field.moves)

    def shares(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """For texts with words: mean probability of each label; how often the label changes."""
        p = self.word_probabilities(texts)
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        best = p.argmax(axis=1)
        changed = np.concatenate([[0], best[1:] != best[:-1]])
        changed[starts] = 0
        return np.add.reduceat(p, starts, axis=0) / sizes[:, None], np.add.reduceat(changed, starts)


def _held_out(id_column: str) -> Column:
    id_text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(id_text.cast("binary")), F.lit(5)) == 0


def learn(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    max_runs: int = MAX_RUNS,
) -> Field | None:
    """A field from the labelled documents that are not held out."""
    labelled = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        F.col(lang_column).cast("string").alias("lang"),
        _held_out(id_column).alias("held_out"),
    ).where("not held_out and lang is not null and text is not null")
    # Written, so that its size is known before the texts would be shuffled for the join.
    counts = settled(labelled.groupBy("lang").agg(F.count("*").alias("n")))
    bits = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(bits)) < F.lit(float(bits * docs_per_language)) / F.col("n")
    few = settled(labelled.join(counts, "lang").where(draw).select("doc_id", "text", "lang"))
    rows = few.orderBy("doc_id", "lang", "text").select("text", "lang").collect()
    return train([(r["text"], r["lang"]) for r in rows], max_runs)


def identify(
    docs: DataFrame, field: Field | None, text_column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """One row per document: row (its columns, or those in ``keep``), lang_pred, score, n_words,
    n_switches."""
    keep = docs.columns if keep is None else keep
    text_at = docs.columns.index(text_column)
    kept_at = [docs.columns.index(c) for c in keep]
    rows = docs.select(F.struct("*").alias("row"))

    def judge(texts: list[list[str]], out: list[list], labeller: Labeller) -> None:
        if not texts:
            return
        shares, switches = labeller.shares(texts)
        best = shares.argmax(axis=1)
        out[0] += [labeller.field.labels[k] for k in best]
        out[1] += np.clip(shares[np.arange(len(best)), best], 0, 1).tolist()
        out[2] += [len(t) for t in texts]
        out[3] += switches.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field) if field is not None else None
        for batch in batches:
            worded, judged, held, texts = [], [[], [], [], []], 0, []
            parts = batch.column("row").flatten()
            for i, text in enumerate(parts[text_at]):
                words = _WORDS((text.as_py() or "").lower())
                if words and labeller is not None:
                    worded.append(i)
                    texts.append(words)
                    held += len(words)
                    if held > _BATCH_WORDS:
                        judge(texts, judged, labeller)
                        texts, held = [], 0
            judge(texts, judged, labeller)
            n = len(batch)
            full = [[UND] * n, [0.0] * n, [0] * n, [0] * n]
            for column, values in zip(full, judged, strict=True):
                for i, value in zip(worded, values, strict=True):
                    column[i] = value
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(full, kinds, strict=True)]
            row = pa.StructArray.from_arrays([parts[k] for k in kept_at], keep)
            yield pa.RecordBatch.from_arrays(
                [row, *arrays], ["row", "lang_pred", "score", "n_words", "n_switches"]
            )

    row = docs.select(*keep).schema.simpleString()
    return rows.mapInArrow(
        run, f"row {row}, lang_pred string, score double, n_words long, n_switches long"
    )


def identified(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """Learns and predicts: doc_id, held_out, lang_pred, score, n_words, n_switches."""
    field = learn(docs, id_column, text_column, lang_column)
    light = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    found = identify(light, field, "text", ["doc_id"]).select("row.doc_id", "*").drop("row")
    return found.withColumn("held_out", _held_out("doc_id")).select(
        "doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches"
    )
