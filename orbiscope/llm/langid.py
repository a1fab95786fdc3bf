"""Language identification with error-correcting output codes.

Every learned language has a codeword.  One linear classifier per bit, over
hashed byte n-grams, says how strongly a text leans to 1 or 0; loss-weighted
decoding sums the logistic loss of each bit, weighted by how well that bit's
classifier separated the language in training, and picks the codeword with the
smallest loss.  A runner-up within ``AMBIGUOUS`` flags the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbiscope.llm.common import broadcast_value, crc32_mod, slices

BUCKETS = 1 << 15
ORDERS = (2, 3)
#: A text is ambiguous when the two best languages' scores differ by less.
AMBIGUOUS = 0.2
#: Bounds of the training sample (rows of a language, and of all) and of the number of features.
SAMPLE_PER_LANGUAGE = 1000
SAMPLE_ROWS = 12_000
FEATURES = 4096
#: Bytes of text whose n-grams are held at a time.
SLICE = 1 << 18
_KNUTH = np.uint32(2654435761)

#: Letters lower-cased, bytes beyond ASCII kept, everything else a blank.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_ASCII_LETTERS = bytes(c for c in range(128) if chr(c).isalpha())


def has_letter(text: bytes | None) -> bool:
    """Whether any character is a letter in the Unicode sense."""
    if not text:
        return False
    if len(text.translate(None, _ASCII_LETTERS)) < len(text):
        return True
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def normalised(text: bytes) -> bytes:
    """Letters with single blanks between and around words."""
    letters = text.translate(LETTERS)
    if len(letters) <= SLICE:
        return b" " + b" ".join(letters.split()) + b" "
    # without a list of all words
    raw = np.frombuffer(letters, np.uint8)
    kept = raw != 32
    kept[1:] |= kept[:-1]
    return b" " + raw[kept].tobytes().strip() + b" "


def ngram_buckets(raw: np.ndarray, orders: tuple[int, ...] = ORDERS) -> list[np.ndarray]:
    """Hash bucket of every n-gram, one array per order; entry i starts at byte i."""
    wide = raw.astype(np.uint32)
    out = []
    for n in orders:
        if len(wide) < n:
            out.append(np.zeros(0, np.int64))
            continue
        code = np.full(len(wide) - n + 1, n, np.uint32)
        for j in range(n):
            code = (code << np.uint32(8)) | wide[j : j + len(code)]
        out.append(((code * _KNUTH) >> np.uint32(32 - 15)).astype(np.int64))
    return out


def bucket_counts(raw: np.ndarray) -> np.ndarray:
    """How often each bucket occurs in one normalised text, which is looked at in slices that overlap by an n-gram."""
    total = np.zeros(BUCKETS, np.int64)
    for a in range(0, len(raw), SLICE):
        for n in ORDERS:
            part = raw[a : a + SLICE + n - 1]
            if len(part) >= n:
                total += np.bincount(ngram_buckets(part, (n,))[0], minlength=BUCKETS)
    return total


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, share of the text's n-grams) of one text."""
    n = bucket_counts(np.frombuffer(normalised(text), np.uint8))
    at = np.flatnonzero(n)
    return at, (n[at] / max(1, n.sum())).astype(np.float32)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k codewords of +1/-1: the exhaustive code for up to 5 languages, else a random code with well separated rows."""
    if k == 0:
        return np.zeros((0, 1), np.float32)
    if k <= 5:
        bits = range(1, max(2, 1 << (k - 1)))
        return np.array([[1 if b >> r & 1 else -1 for b in bits] for r in range(k)], np.float32)
    rng, length = np.random.default_rng(seed), int(np.ceil(10 * np.log2(k)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.float32), (k, length))
        least = int(((length - code @ code.T) / 2 + length * np.eye(k)).min())
        if least > apart and (np.abs(code.sum(0)) < k).all():
            best, apart = code, least
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray
    trust: np.ndarray  # languages x bits, each row sums to 1

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language index, score per language) for rows of bit margins; the scores of a row sum to 1."""
        loss = np.logaddexp(0, -self.code[None] * margins[:, None])  # rows x languages x bits
        total = -(loss * self.trust[None]).sum(2) * self.code.shape[1]
        share = np.exp(total - total.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        return share.argmax(1), share

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Bit margins of whole texts; long ones one by one, short ones together."""
        short = [i for i, t in enumerate(texts) if len(t) <= SLICE]
        out = np.empty((len(texts), len(self.bias)), np.float64)
        first, held = 0, 0
        for k, i in enumerate(short):
            held += len(texts[i])
            if held >= SLICE or k + 1 == len(short):
                out[short[first : k + 1]] = self._short_margins([texts[j] for j in short[first : k + 1]])
                first, held = k + 1, 0
        for i, t in enumerate(texts):
            if len(t) > SLICE:
                n = bucket_counts(np.frombuffer(normalised(t), np.uint8))
                out[i] = n @ self.weights.astype(np.float64) / max(1, n.sum()) + self.bias
        return out

    def _short_margins(self, texts: list[bytes]) -> np.ndarray:
        """Bit margins of texts that are laid end to end; n-grams never reach over two texts."""
        parts = [normalised(t) for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        starts = ends - [len(p) for p in parts]
        total = np.zeros((len(texts), len(self.bias)), np.float64)
        count = np.zeros(len(texts))
        raw = np.frombuffer(b"".join(parts), np.uint8)
        for n, buckets in zip(ORDERS, ngram_buckets(raw), strict=True):
            if not len(buckets):
                continue
            values = self.weights[buckets]
            for over in range(1, n):  # n-grams that begin in one text and end in the next
                cut = ends[:-1] - over
                values[cut[(cut >= 0) & (cut < len(values))]] = 0
            inside = starts < len(values)
            total[inside] += np.add.reduceat(values, starts[inside], axis=0)
            count += np.maximum(0, ends - starts - n + 1)
        return total / np.maximum(1, count)[:, None] + self.bias


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], steps: int = 150, rate: float = 0.02) -> LanguageModel:
    """Train one logistic classifier per codeword bit by full-batch Adam on (buckets, shares, language) rows.

    The FEATURES buckets with the largest total share are used.
    """
    languages = sorted({r[2] for r in rows})
    code = codewords(len(languages))
    if len(languages) < 2:
        bits = code.shape[1]
        none = np.zeros((BUCKETS, bits), np.float32)
        bias = np.full(bits, 4.0) * (code[0] if languages else 1)
        return LanguageModel(languages, code, none, bias, np.full((max(1, len(languages)), bits), 1 / bits))
    truth = np.array([languages.index(r[2]) for r in rows])
    weight = (1 / np.bincount(truth)[truth] / len(languages)).astype(np.float32)  # every language counts the same
    mass = np.zeros(BUCKETS)
    for at, share, _ in rows:
        mass[at] += share
    used = np.sort(np.argsort(-mass, kind="stable")[: min(FEATURES, int((mass > 0).sum()))])
    column = np.full(BUCKETS, -1)
    column[used] = np.arange(len(used))
    x = np.zeros((len(rows), len(used)), np.float32)
    for i, (at, share, _) in enumerate(rows):
        known = column[at] >= 0
        x[i, column[at[known]]] = share[known]
    scale = 1 / np.maximum(1e-4, np.sqrt((x * x).mean(0)) * np.sqrt(len(used)))
    x *= scale
    sign = code[truth]
    w, b = np.zeros((len(used), code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    moments = [[np.zeros_like(w), np.zeros_like(w)], [np.zeros_like(b), np.zeros_like(b)]]
    for step in range(1, steps + 1):
        pull = -sign * weight[:, None] / (1 + np.exp(np.clip(sign * (x @ w + b), -50, 50)))
        for value, grad, (m, v) in ((w, x.T @ pull + 1e-5 * w, moments[0]), (b, pull.sum(0), moments[1])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    right = sign * (x @ w + b) > 0
    trust = np.array([right[truth == k].mean(0) for k in range(len(languages))]) + 1e-3
    table = np.zeros((BUCKETS, code.shape[1]), np.float32)
    table[used] = w * scale[:, None]
    return LanguageModel(languages, code, table, b, trust / trust.sum(1, keepdims=True))


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel:
    """Fit on a sample of the rows of ``docs`` with text and language.

    The sample is drawn by a hash of the id so that about
    ``per_language`` rows of each language are expected (all, where there are
    fewer), and an equal share of ``sample_rows`` where there are very many
    languages; features are made on the executors and each is a share of a whole
    text's n-grams.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    counts = labelled.groupBy("lang").count()
    languages = counts.count()
    wanted = min(per_language, max(1, sample_rows // max(1, languages)))
    # one row per language: as many as there are languages
    shares = F.broadcast(counts.select("lang", F.least(F.lit(1.0), wanted / F.col("count")).alias("share")))
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    sample = labelled.join(shares, "lang").where(draw).select("text", "lang")

    def kernel(batches):
        for batch in batches:
            rows = [features(t) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            yield pa.record_batch(
                [
                    pa.array([a.astype(np.int16).tobytes() for a, _ in rows], pa.binary()),
                    pa.array([s.astype(np.float16).tobytes() for _, s in rows], pa.binary()),
                    batch.column(1),
                ],
                names=["at", "share", "lang"],
            )

    got = sample.mapInArrow(kernel, "at binary, share binary, lang string").toLocalIterator()
    return fit(
        [
            (np.frombuffer(r.at, np.int16).astype(np.int64), np.frombuffer(r.share, np.float16).astype(np.float32), r.lang)
            for r in got
        ]
    )


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, ambiguous) for every row.

    A text without a letter (null, empty, digits only) is ``und`` with score 0
    and ambiguous.  ``score`` is the chosen language's share, 0 to 1.  Ties go
    to the language that sorts first.  Map-side only.
    """
    shared = broadcast_value(docs.sparkSession, model, 64 << 20, "language model")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                lang, score, unsure = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
                known = [i for i, t in enumerate(texts) if has_letter(t)] if m.languages else []
                if known:
                    best, share = m.decode(m.margins([texts[i] for i in known]))
                    ranked = np.sort(share, axis=1)
                    gap = ranked[:, -1] - (ranked[:, -2] if share.shape[1] > 1 else 0)
                    for i, b, s, g in zip(known, best, ranked[:, -1], gap, strict=True):
                        lang[i], score[i], unsure[i] = m.languages[b], float(s), bool(g < AMBIGUOUS)
                yield pa.record_batch(
                    [part.column(0), pa.array(lang), pa.array(score), pa.array(unsure)],
                    names=["key", "lang_pred", "score", "ambiguous"],
                )

    keyed = docs.select(F.col(id_col).alias("key"), F.col(text_col))
    kind = keyed.schema["key"].dataType.simpleString()
    found = keyed.mapInArrow(kernel, f"key {kind}, lang_pred string, score double, ambiguous boolean")
    return found.withColumnRenamed("key", id_col)


def digest_query(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out (crc32 of the id mod 4 is not 2), predict all."""
    held_out = F.coalesce(crc32_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train(docs.where(~held_out))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text has no language: no letter in it, or null.

    The other rows keep all their columns, and ``lang`` takes the prediction
    unless that is ambiguous and the row already names a language.  When no
    language could be learned, it stays as it is.
    """
    model = train(docs.where(F.coalesce(crc32_mod(F.col("doc_id"), 4) != 2, F.lit(True))))
    shared = broadcast_value(docs.sparkSession, model, 64 << 20, "language model")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            at_text, at_lang = batch.schema.get_field_index("text"), batch.schema.get_field_index("lang")
            for part in slices(batch, at_text):
                texts = part.column(at_text).cast(pa.binary()).to_pylist()
                keep = [has_letter(t) for t in texts]
                if not any(keep):
                    continue
                part = part.filter(pa.array(keep))
                if not m.languages:
                    yield part
                    continue
                best, share = m.decode(m.margins([t for t, k in zip(texts, keep, strict=True) if k]))
                ranked = np.sort(share, axis=1)
                gap = ranked[:, -1] - (ranked[:, -2] if share.shape[1] > 1 else 0)
                old = part.column(at_lang).to_pylist()
                new = [
                    o if o is not None and g < AMBIGUOUS else m.languages[b] for o, b, g in zip(old, best, gap, strict=True)
                ]
                yield part.set_column(at_lang, batch.schema.field(at_lang), pa.array(new, batch.schema.field(at_lang).type))

    return docs.mapInArrow(kernel, docs.schema)
