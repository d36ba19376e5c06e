"""Token counts by a linear longest-match automaton.

Greedy longest-match-first pieces of a word are counted without building them. The vocabulary is a trie of initial and
continuation pieces; each node has a failure link, to the node of what remains once the longest pieces at the front of its string
are taken off, and the number of pieces taken off. So each character is read once and each failure adds a stored number.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words: runs of anything but white space and ASCII punctuation, and each punctuation sign.
WORD = re.compile(r"[^\s!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]")


class PieceCounter:
    """Counts the pieces of words. first: pieces that start a word; rest: pieces that continue it."""

    def __init__(self, first: Iterable[str], rest: Iterable[str], kept: int = 250_000):
        self.go: list[dict[str, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in ((0, first), (1, rest)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.go[node]:
                        self.go[node][c] = len(self.go)
                        self.go.append({})
                        whole.append(False)
                    node = self.go[node][c]
                if piece:
                    whole[node] = True
        self.fail, self.popped = [-1] * len(self.go), [0] * len(self.go)
        level = [0, 1]
        while level:  # by length of the strings
            deeper = []
            for parent in level:
                for c, node in self.go[parent].items():
                    if whole[node]:
                        self.fail[node], self.popped[node] = 1, 1
                    else:
                        z, pops = self.fail[parent], self.popped[parent]
                        while z >= 0 and c not in self.go[z]:
                            pops += self.popped[z]
                            z = self.fail[z]
                        if z >= 0:
                            self.fail[node], self.popped[node] = self.go[z][c], pops
                    deeper.append(node)
            level = deeper
        self.kept, self.known = kept, {}

    def count(self, word: str) -> int:
        """Pieces of one word; 0 if it cannot be split into pieces."""
        go, fail, popped, node, n = self.go, self.fail, self.popped, 0, 0
        for c in word:
            while (to := go[node].get(c)) is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = to
        while node != 1:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return 0
        return n

    def text(self, text: str | None) -> tuple[int, int, int]:
        """Words, tokens and unknown words of a text; an unknown word is one token."""
        known, words = self.known, WORD.findall(text or "")
        tokens = unknown = 0
        for word in words:
            n = known.get(word)
            if n is None:
                n = self.count(word)
                if len(known) >= self.kept:
                    known.clear()
                if len(word) <= 32:
                    known[word] = n
            tokens += n or 1
            unknown += not n
        return len(words), tokens, unknown


def pieces_of_model(path: str, blank: str = "▁") -> tuple[list[str], list[str]]:
    """Initial and continuation pieces from a SentencePiece vocabulary: those with the blank mark in front start words."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    first = [p[1:] for p in pieces if p.startswith(blank) and p.strip(blank) and blank not in p[1:]]
    return first, [p for p in pieces if blank not in p]


_COUNTERS: dict[str, PieceCounter] = {}


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = PieceCounter(*pieces_of_model(path))
        count = _COUNTERS[path].text
        for batch in batches:
            found = [count(text.as_py()) for text in batch.column(1)]
            yield pa.record_batch([batch.column(0), *(pa.array([f[k] for f in found], pa.int64()) for k in range(3))], ["row", "n_words", "n_tokens", "n_unknown"])

    return run


def token_counts(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of whole texts under greedy longest-match pieces.

    A word that no sequence of longest matches covers is one unknown token. Null and empty texts have none. Null ids and
    repeated rows pass through. Other columns are ignored. model_path is read by each worker.
    """
    base = docs.select(F.col(id_column).cast("long").alias("row"), F.col(text_column).cast("string").alias("text"))
    return base.mapInArrow(_counts(model_path), "row long, n_words long, n_tokens long, n_unknown long").withColumnRenamed("row", "doc_id")
