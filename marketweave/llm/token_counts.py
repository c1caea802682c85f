"""Token counts by dynamic programming over a trie of pre-tokens.

A pre-token is the mark U+2581 and a run of characters without white space. A unigram model cuts it into the pieces of
highest summed log-probability; a character that no piece covers falls back to one token per UTF-8 byte. Each task
inserts its distinct pre-tokens in one trie whose nodes hold the best score and token count up to there, so a prefix that
many words share is scored once; the end of a word is a lookup. Counts of words met before are kept beside the trie. Both
are started anew beyond ``most_nodes``: this bounds memory and changes no result.

Scores: the vocabulary file gives its pieces in order of rank; the log-probability of rank r is taken from the
Zipf-Mandelbrot law, -log(r + 2.7) less the log of the sum.
"""

from __future__ import annotations

import functools
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, passes

MARK = "▁"
MOST_NODES = 1_200_000


def unigram_scores(model_file: str) -> tuple[dict[str, float], float]:
    """Log-probabilities of the pieces of a SentencePiece file, and the one of a byte that stands for itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    weight = 1 / (np.arange(len(pieces)) + 2.7)
    logs = np.log(weight / weight.sum())
    return dict(zip(pieces, logs.tolist(), strict=True)), float(logs[-1]) - 10.0


class PrefixTrie:
    """Nodes are numbers; children by (node, character) as one number; score and tokens hold the best cut up to each node."""

    def __init__(self, scores: dict[str, float], byte_score: float):
        self.scores, self.byte_score = scores, byte_score
        self.tails = {piece[i:] for piece in scores for i in range(len(piece))}
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.score, self.tokens = array("d", [0.0]), array("i", [0])
        self.done: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """Tokens of the best cut of the mark and ``word``; of equal scores the one with fewest tokens."""
        if len(self.score) > MOST_NODES:
            self.clear()
        child, score, tokens, scores, tails = self.child, self.score, self.tokens, self.scores, self.tails
        text = MARK + word
        node, path, end = 0, [0], 0
        for char in text:
            end += 1
            key = node << 21 | ord(char)
            node = child.get(key)
            if node is None:
                n = 1 if char < "\x80" else len(char.encode("utf-8", "surrogatepass"))
                top, count = score[path[-1]] + n * self.byte_score, tokens[path[-1]] + n
                start = end - 1
                while start >= 0 and (piece := text[start:end]) in tails:  # else no piece ends like this, nor in anything longer
                    own = scores.get(piece)
                    if own is not None:
                        at = path[start]
                        own += score[at]
                        if own > top or own == top and tokens[at] < count - 1:
                            top, count = own, tokens[at] + 1
                    start -= 1
                node = child[key] = len(score)
                score.append(top)
                tokens.append(count)
            path.append(node)
        self.done[word] = count = tokens[node]
        return count


@functools.cache
def prefix_trie(model_file: str) -> PrefixTrie:
    """One for each Python worker, so that later tasks find the prefixes of earlier ones."""
    return PrefixTrie(*unigram_scores(model_file))


def count_tokens(documents: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """doc_id, n_chars, n_pretokens, n_distinct, n_tokens (long) for every row. Null or blank text has none; rows and ids may repeat; other columns are left out.

    Of cuts with one score the model's first is taken, which does not change the count's meaning. Texts of any length are
    counted whole. An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = prefix_trie(model_file)
        for batch, texts in passes(batches, "text"):
            out = []
            for doc, x in zip(column(batch, "doc_id").to_pylist(), texts.to_pylist(), strict=True):
                words, total = Counter(x.split()), 0
                for w, n in words.items():
                    known = trie.done.get(w)
                    total += n * (trie.insert(w) if known is None else known)
                out.append((doc, len(x), words.total(), len(words), total))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "n_chars", "n_pretokens", "n_distinct", "n_tokens"])

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_chars long, n_pretokens long, n_distinct long, n_tokens long")
