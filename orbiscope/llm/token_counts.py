"""Token counts under a unigram vocabulary, with a trie shared by all pre-tokens.

A text's pre-tokens are its words with the blank before them.  The distinct
pre-tokens of a batch go into one trie; walking it once computes the unigram
forward score of every prefix a single time however many pre-tokens share it,
and each terminal node stores the number of pieces on its best path.  A text's
count is the sum over its pre-tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbiscope.llm.common import broadcast_value, slices

BLANK = "▁"
#: Score of a character without a piece, per byte of it (a vocabulary with byte fallback spends one piece per byte).
BYTE_SCORE = -24.0


@dataclass(frozen=True)
class UnigramVocabulary:
    scores: dict[str, float]
    longest: int

    @classmethod
    def of_pieces(cls, pieces: list[str]) -> UnigramVocabulary:
        """Scores by Zipf's law from the order of the pieces, most frequent first: -log(rank + 10)."""
        from math import log

        return cls({p: -log(i + 10) for i, p in enumerate(pieces)}, max(map(len, pieces), default=1))


def load_vocabulary(path: str) -> UnigramVocabulary:
    """The ordinary pieces of a sentencepiece model file in the order of their scores (blank-only pieces come last)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    plain.sort(key=lambda i: -model.get_score(i))
    return UnigramVocabulary.of_pieces([model.id_to_piece(i) for i in plain])


def piece_trie(scores: dict[str, float]) -> dict:
    """The pieces as nested dictionaries by character; the key '' holds a piece's score."""
    root: dict = {}
    for piece, score in scores.items():
        node = root
        for c in piece:
            node = node.setdefault(c, {})
        node[""] = score
    return root


class PrefixTrie:
    """Pre-tokens as a trie; ``count`` runs the forward program over it once.

    A node is the dictionary of its children by character; the key '' marks a
    terminal node and holds its pre-token.
    """

    def __init__(self, pieces: dict):
        self.pieces = pieces
        self.root: dict = {}

    def insert(self, token: str) -> None:
        node = self.root
        for c in token:
            node = node.setdefault(c, {})
        node[""] = token

    def count(self) -> dict[str, int]:
        """{pre-token: pieces on its best path}; of equal scores the fewer pieces.

        Every node carries its prefix's forward score and the pieces that have
        begun on the way to it and may still grow, each with the score at its
        beginning.
        """
        found: dict[str, int] = {}
        first = self.pieces
        todo: list[tuple[dict, list, float, int]] = [(self.root, [], 0.0, 0)]
        while todo:
            node, growing, score, used = todo.pop()
            for c, child in node.items():
                if c == "":
                    found[child] = used
                    continue
                todo.append((child, *step(first, c, growing, score, used)))
        return found


def step(first: dict, c: str, growing: list, score: float, used: int) -> tuple[list, float, int]:
    """The state of ``PrefixTrie.count`` one character further."""
    begun = first.get(c)
    own = None if begun is None else begun.get("")
    if own is None:
        size = len(c.encode("utf-8", "surrogatepass"))
        best, pieces = score + size * BYTE_SCORE, used + size
    else:
        best, pieces = score + own, used + 1
    still = [] if begun is None else [(begun, score, used)]
    for piece, base, before in growing:
        longer = piece.get(c)
        if longer is None:
            continue
        s = longer.get("")
        if s is not None:
            total = base + s
            if total > best or total == best and before + 1 < pieces:
                best, pieces = total, before + 1
        still.append((longer, base, before))
    return still, best, pieces


def count_long(first: dict, token: str) -> int:
    """Pieces on the best path of one pre-token of any length; only the growing pieces are held."""
    state: tuple[list, float, int] = ([], 0.0, 0)
    for c in token:
        state = step(first, c, *state)
    return state[2]


class TokenCounter:
    """Counts of texts; keeps the counts of pre-tokens seen, up to a bound."""

    BOUND = 1 << 18
    #: Longer pre-tokens are streamed outside the trie, so that its depth and the cache stay bounded.
    #: They are scored whole; ``n_pretokens`` counts them once per this many characters begun.
    LONGEST = 256

    def __init__(self, vocabulary: UnigramVocabulary):
        self.pieces = piece_trie(vocabulary.scores)
        self.known: dict[str, int] = {}

    def pretokens(self, text: str) -> list[str]:
        """Words between blanks, each with the blank's sign; other white space stays inside a word."""
        if not text:
            return []
        return (BLANK + text.replace(" ", " " + BLANK)).split(" ")

    def __call__(self, texts: list[str]) -> list[tuple[int, int]]:
        """(tokens, pre-tokens) of each text."""
        split = [self.pretokens(t) for t in texts]
        extra = [(0, 0)] * len(texts)  # what long pre-tokens add
        for i, tokens in enumerate(split):
            if tokens and max(map(len, tokens)) > self.LONGEST:
                long = [w for w in tokens if len(w) > self.LONGEST]
                split[i] = [w for w in tokens if len(w) <= self.LONGEST]
                extra[i] = sum(count_long(self.pieces, w) for w in long), sum(-(-len(w) // self.LONGEST) for w in long)
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > self.BOUND:
            self.known, new = {}, set().union(*split)
        trie = PrefixTrie(self.pieces)
        for token in new:
            trie.insert(token)
        self.known.update(trie.count())
        get = self.known.__getitem__
        return [(sum(map(get, tokens)) + n, len(tokens) + k) for tokens, (n, k) in zip(split, extra, strict=True)]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_pretokens) for every row; map-side only.

    Null and empty texts have 0 of both.  A character without a piece counts one
    token per byte.  A word of any length is scored whole; ``n_pretokens`` counts
    it once per TokenCounter.LONGEST characters begun.  ``vocabulary`` is a
    sentencepiece model file that the driver can open; it is broadcast (at most
    64 MB).
    """
    shared = broadcast_value(docs.sparkSession, load_vocabulary(vocabulary), 64 << 20, "vocabulary")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(shared.value)
        for batch in batches:
            for part in slices(batch, 1):
                found = counter([t or "" for t in part.column(1).to_pylist()])
                yield pa.record_batch(
                    [part.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())],
                    names=["key", "n_tokens", "n_pretokens"],
                )

    keyed = docs.select(F.col(id_col).alias("key"), F.col(text_col))
    kind = keyed.schema["key"].dataType.simpleString()
    return keyed.mapInArrow(kernel, f"key {kind}, n_tokens long, n_pretokens long").withColumnRenamed("key", id_col)


def count_query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
