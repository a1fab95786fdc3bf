"""Toxicity by multiple-instance learning: sentences are the instances, documents carry the labels.

A sentence is toxic with probability sigmoid(bias + sum of its feature weights);
the features of a word are the word and its beginnings (so that an inflected
form not seen in training shares its stem's weight).  A document is toxic when
any sentence is (noisy-or): 1 - prod(1 - p).  Weights are trained by gradient
descent on the documents' labels alone, and the trained sentence scores then
locate the offending sentences.

What nearly every sentence of clean documents has is background: probabilities
are counted from there, so that a text does not become toxic by its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbiscope.llm.common import broadcast_value, crc32_mod, cut, slices

#: Bounds of the training sample (labelled documents) and of the vocabulary.
SAMPLE_DOCS = 12_000
VOCABULARY = 4096
#: A feature enters the vocabulary from this many toxic documents and this many standard errors above the base rate.
MIN_DOCS = 6
MIN_SURPRISE = 4.0
#: Lengths, in characters, of the beginnings of a word that are features.
BEGINNINGS = (3, 4, 5, 6)
#: Relative learning rates of the beginnings and of whole words.
STEM_PACE = {3: 1.0, 4: 1.0, 5: 0.5, 6: 0.25}
WORD_PACE = 0.25
#: The background is below all but this share of the sentences of clean training documents.
ABOVE_BACKGROUND = 0.001
#: A sentence at or above this probability is reported.
SENTENCE_SCORE = 0.5

SENTENCE_END = re.compile(rb"[.!?\n]+")
#: Letters and digits lower-cased, bytes beyond ASCII kept, sentence ends kept, everything else a blank.
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 or chr(c) in ".!?\n" else 32
    for c in range(256)
)


def sentences(text: bytes | None) -> list[list[bytes]]:
    """The words of each sentence; sentences without words are left out."""
    if not text:
        return []
    return [w for s in SENTENCE_END.split(text.translate(WORDS)) if (w := s.split())]


def word_features(word: bytes) -> list[bytes]:
    """The word itself, and its beginnings marked with an asterisk."""
    text = word.decode("utf-8", "replace")
    return [word, *(text[:n].encode() + b"*" for n in BEGINNINGS if len(text) >= n)]


class Lookup(dict):
    """word -> what ``make`` gives for it, emptied when it grows beyond a bound."""

    BOUND = 1 << 18

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: bytes):
        if len(self) >= self.BOUND:
            self.clear()
        self[word] = found = self.make(word)
        return found


@dataclass
class ToxicityModel:
    weights: dict[bytes, float]
    bias: float
    background: float = 0.0

    def word_weights(self) -> Lookup:
        get = self.weights.get
        return Lookup(lambda word: sum(get(f, 0.0) for f in word_features(word)))

    def sentence_scores(self, text: bytes | None, lookup: Lookup | None = None) -> np.ndarray:
        weight = (self.word_weights() if lookup is None else lookup).__getitem__
        z = np.array([sum(map(weight, s)) for s in sentences(text)], float) + self.bias
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        return np.maximum(0, (p - self.background) / (1 - self.background))


def noisy_or(p: np.ndarray) -> float:
    """The probability that any of independent events happens; 0 for none."""
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))


def fit(
    docs: list[tuple[int, np.ndarray, np.ndarray]],
    labels: np.ndarray,
    words: list[bytes],
    steps: int = 400,
    rate: float = 0.1,
    decay: float = 2e-4,
) -> ToxicityModel:
    """Train on documents given as (number of sentences, sentence of each known word, that word's position in ``words``).

    Full-batch Adam on the noisy-or log loss.  Sentences without known words
    share one probability, so they enter by their number only.
    """
    if not len(labels) or labels.min() == labels.max():
        rate_of = float(labels.mean()) if len(labels) else 0.0
        return ToxicityModel({}, -20.0 if rate_of < 0.5 else 20.0)
    entry_word = np.concatenate([d[2] for d in docs]).astype(np.int64)
    spread = np.cumsum([0] + [d[0] for d in docs])
    entry_sentence, entry_of = np.unique(
        np.concatenate([spread[i] + d[1] for i, d in enumerate(docs)]).astype(np.int64), return_inverse=True
    )
    sentence_doc = np.searchsorted(spread, entry_sentence, side="right") - 1
    plain = np.array([d[0] for d in docs]) - np.bincount(sentence_doc, minlength=len(docs))
    y, n = labels.astype(float), len(docs)
    params = np.zeros(len(words) + 1)
    params[-1] = -6.0
    # shorter beginnings learn faster, so that a stem carries more of the weight than its seen forms
    pace = np.array([STEM_PACE.get(len(w.decode("utf-8", "replace")) - 1, 1.0) if w.endswith(b"*") else WORD_PACE for w in words] + [1.0])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, b = params[:-1], params[-1]
        z = np.bincount(entry_of, w[entry_word], minlength=len(entry_sentence)) + b
        # log(1 - p) of a sentence is -softplus(z)
        quiet = -np.logaddexp(0, z)
        clean = np.bincount(sentence_doc, quiet, minlength=n) - plain * np.logaddexp(0, b)
        p = -np.expm1(np.minimum(clean, -1e-9))
        # d loss / d clean; d clean / d z = -sigmoid(z)
        slope = np.where(y == 1, np.exp(clean) / p, -1.0) / n
        pull = slope[sentence_doc] * -(1 / (1 + np.exp(-np.clip(z, -50, 50))))
        grad = np.empty_like(params)
        grad[:-1] = np.bincount(entry_word, pull[entry_of], minlength=len(words)) + decay * np.sign(w)
        grad[-1] = pull.sum() - (slope * plain).sum() / (1 + np.exp(-b))
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        params -= rate * pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-10)
    params[:-1][np.abs(params[:-1]) <= 0.05] = 0
    weights = {w: float(x) for w, x in zip(words, params[:-1], strict=True) if x}
    return ToxicityModel(weights, float(params[-1]), background(params, entry_of, entry_word, sentence_doc, plain, y))


def background(params, entry_of, entry_word, sentence_doc, plain, y) -> float:
    """A sentence probability that all but ABOVE_BACKGROUND of the clean documents' sentences stay within.

    At least that of a sentence without known words; far below SENTENCE_SCORE in any case.
    """
    z = np.bincount(entry_of, params[:-1][entry_word], minlength=len(sentence_doc))[y[sentence_doc] == 0] + params[-1]
    above = max(1, int(ABOVE_BACKGROUND * (len(z) + plain[y == 0].sum())))
    level = np.sort(z)[-above] if len(z) >= above else params[-1]
    return float(min(0.1, 1 / (1 + np.exp(-max(level, params[-1])))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_docs: int = SAMPLE_DOCS,
    vocabulary: int = VOCABULARY,
) -> ToxicityModel:
    """Fit on at most ``sample_docs`` labelled documents, drawn by a hash of the id.

    Labels other than 0 and 1 are left out; of several labels of one id the
    largest counts, of several texts of one id the first in order.  The vocabulary holds the ``vocabulary`` features that
    stand out most among toxic documents, given MIN_DOCS and MIN_SURPRISE.
    """
    sample = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("key"))
        .agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(sample_docs)
    )
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    # sample_docs rows at most, read once
    drawn = cut(texts.join(F.broadcast(sample), "key").groupBy("key", "label").agg(F.min("text").alias("text")).drop("key"))

    def count(batches):
        known = Lookup(word_features)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            seen: dict[tuple[bytes, int], int] = {}
            total = [0, 0]
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                total[label] += 1
                for f in {f for w in {w for s in sentences(text) for w in s} for f in known[w]}:
                    seen[f, label] = seen.get((f, label), 0) + 1
            rows = [(w, label, n) for (w, label), n in seen.items()] + [(b"", k, total[k]) for k in (0, 1)]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.int32(), pa.int64()), strict=True)],
                names=["word", "label", "n"],
            )

    counted = (
        drawn.mapInArrow(count, "word binary, label int, n long")
        .groupBy("word")
        .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n"))
    )
    total = counted.where(F.length("word") == 0).first()
    if total is None or not 0 < total.bad < total.n:
        return ToxicityModel({}, 20.0 if total is not None and total.bad else -20.0)
    base = total.bad / total.n
    surprise = (F.col("bad") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base))
    chosen = (
        counted.where((F.length("word") > 0) & (F.col("bad") >= MIN_DOCS) & (surprise >= MIN_SURPRISE))
        .orderBy(surprise.desc(), "word")
        .limit(vocabulary)
        .select("word")
    )
    words = sorted(bytes(r.word) for r in chosen.collect())
    where = broadcast_value(docs.sparkSession, {w: i for i, w in enumerate(words)}, 16 << 20, "vocabulary")

    def encode(batches):
        get = where.value.get
        known = Lookup(lambda word: [x for f in word_features(word) if (x := get(f)) is not None])
        for batch in (part for whole in batches for part in slices(whole, 1)):
            out = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                found = sentences(text)
                pairs = sorted({(i, x) for i, s in enumerate(found) for w in s for x in known[w]})
                out.append((label, len(found), [i for i, _ in pairs], [x for _, x in pairs]))
            ints = pa.list_(pa.int32())
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), ints, ints), strict=True)],
                names=["label", "n", "sentence", "word"],
            )

    rows = list(
        drawn.mapInArrow(encode, "label int, n long, sentence array<int>, word array<int>").toLocalIterator()
    )
    return fit(
        [(r.n, np.array(r.sentence, np.int64), np.array(r.word, np.int64)) for r in rows],
        np.array([r.label for r in rows]),
        words,
    )


def score(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", sentence_score: float = SENTENCE_SCORE
) -> DataFrame:
    """(id_col, score, sentences) for every row; map-side only.

    ``sentences`` lists the offending ones as (sentence, score), the former counting
    the text's sentences that have words from 0.  Null and empty texts have no
    sentences and score 0.
    """
    shared = broadcast_value(docs.sparkSession, model, 16 << 20, "toxicity model")
    listed = pa.list_(pa.struct([("sentence", pa.int32()), ("score", pa.float64())]))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lookup = m.word_weights()
        for batch in batches:
            for part in slices(batch, 1):
                total, bad = [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    p = m.sentence_scores(text, lookup)
                    total.append(noisy_or(p))
                    bad.append([{"sentence": int(i), "score": float(p[i])} for i in np.flatnonzero(p >= sentence_score)])
                yield pa.record_batch(
                    [part.column(0), pa.array(total, pa.float64()), pa.array(bad, listed)], names=["key", "score", "sentences"]
                )

    keyed = docs.select(F.col(id_col).alias("key"), F.col(text_col))
    kind = keyed.schema["key"].dataType.simpleString()
    found = keyed.mapInArrow(kernel, f"key {kind}, score double, sentences array<struct<sentence:int,score:double>>")
    return found.withColumnRenamed("key", id_col)


def digest_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels of rows that are not held out (crc32 of the id mod 5 is not 0), score all."""
    held_out = F.coalesce(crc32_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    model = train(docs, labels.where(~held_out))
    return score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("sentences").alias("n_sentences"),
    )
