"""SentencePiece encoding and decoding for vocabularies of the merge type.

Encoding starts with the characters of a text and keeps an agenda of adjacent symbol pairs whose joined piece is in the vocabulary,
ordered by score and then from left to right; the best pair merges and its new neighbours enter the agenda. Where no
piece of the vocabulary has a blank mark or an ASCII sign behind another character, or a line feed, merges cannot cross
these places, so the agenda works on one stretch at a time and its ids are kept for the stretches that come again. Each Arrow batch is
then checked against the sentencepiece library.
"""

from __future__ import annotations

import hashlib
import heapq
import operator
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.words import slices

#: The blank mark of a vocabulary; here pieces and texts are kept with plain blanks, which stand for the same symbol.
BLANK = "▁"
_BEFORE, _AFTER = list(range(-1, 63)), list(range(1, 65))

#: Places of the table of stretches that have been met.
MET = 1 << 21

#: Signs before which merges end behind any character that no piece has in front of such a sign.
MARKS = "!-/:-@\\[-`{-~"


def stretch_pattern(pieces: Iterable[str]) -> str:
    """Pattern of the stretches of a text that merges cannot leave, by which neighbours the pieces have."""
    pairs = {a + b for piece in pieces for a, b in zip(piece, piece[1:])}
    if any("\n" in p or (p[1] == " " and p[0] != " ") for p in pairs):
        return r"(?s:.+)"
    stick = "".join(sorted({re.escape(p[0]) for p in pairs if re.fullmatch(f"[^ {MARKS}][{MARKS}]", p)}))
    plain, other = f"[^ \n{MARKS}{stick}]", f"[{MARKS}{stick}]"
    more = f"(?:[{stick}]{other}*{plain}*)*" if stick else ""
    return f" *(?:{plain}+{more}|{other}+{plain}*{more})| +|\n"


class MergeEncoder:
    """Encoder for one model file; `library` is the sentencepiece processor of the same file."""

    def __init__(self, path: str, kept: int = 200_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix or any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("needs a merge-type vocabulary with identity normalisation and no user-defined or unused pieces")
        self.prefix = " " if spec.add_dummy_prefix else ""
        self.packed = {p.piece.replace(BLANK, " "): pack([i]) for i, p in enumerate(model.pieces) if p.type == 1}
        scores = sorted({p.score for p in model.pieces if p.type == 1}, reverse=True)
        place = {score: k for k, score in enumerate(scores)}
        self.rank = {p.piece.replace(BLANK, " "): place[p.score] for p in model.pieces if p.type == 1}
        byte_ids = [i for i, p in enumerate(model.pieces) if p.type == 6]
        if not model.trainer_spec.byte_fallback or len(byte_ids) != 256:
            raise ValueError("needs byte pieces for unknown characters")
        self.bytes, self.begin, self.end = [pack([i]) for i in byte_ids], pack([self.library.bos_id()]), pack([self.library.eos_id()])
        self.stretches = re.compile(stretch_pattern(self.rank)).findall
        self.kept, self.known, self.older, self.met = kept, _Known(self), {}, bytearray(MET)

    def merge(self, stretch: str) -> list[str]:
        """The symbols of a stretch after all merges. An agenda entry is a rank of score and the place of the left symbol."""
        rank, n = self.rank, len(stretch)
        bits = n.bit_length()
        place = (1 << bits) - 1
        symbols: list[str | None] = list(stretch)
        before, after = (_BEFORE[:n], _AFTER[:n]) if n <= len(_AFTER) else (list(range(-1, n - 1)), list(range(1, n + 1)))
        agenda = [rank[pair] << bits | i for i, pair in enumerate(map(operator.add, stretch, stretch[1:])) if pair in rank]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry & place
            if symbols[left] is None or (right := after[left]) == n:
                continue
            joined = symbols[left] + symbols[right]
            if rank.get(joined) != entry >> bits:
                continue  # one of the two has merged since
            symbols[left], symbols[right] = joined, None
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                if (r := rank.get(joined + symbols[nxt])) is not None:
                    heapq.heappush(agenda, r << bits | left)
            prev = before[left]
            if prev >= 0 and (r := rank.get(symbols[prev] + joined)) is not None:
                heapq.heappush(agenda, r << bits | prev)
        return [s for s in symbols if s is not None]

    def packed_ids(self, stretch: str) -> bytes:
        """Ids of a stretch that is not among the known; two generations are kept of stretches that came before."""
        ids = self.older.get(stretch)
        if ids is None:
            ids, at = self.symbol_ids(self.merge(stretch)), hash(stretch) % MET
            if not self.met[at]:  # most stretches come only once
                self.met[at] = 1
                return ids
        if len(self.known) >= self.kept:
            self.known, self.older, self.met = _Known(self), self.known, bytearray(MET)
        if len(stretch) <= 32:
            self.known[stretch] = ids
        return ids

    def symbol_ids(self, symbols: list[str]) -> bytes:
        get = self.packed.get
        return b"".join([get(x) or b"".join([self.bytes[b] for b in x.encode("utf-8")]) for x in symbols])

    def encode(self, text: str) -> bytes:
        """Ids of a text between the begin and the end id, as little-endian unsigned 32-bit integers."""
        stretches = self.stretches(self.prefix + text.replace(BLANK, " ")) if text else ()
        return b"".join((self.begin, *map(self.known.__getitem__, stretches), self.end))


class _Known(dict):
    """Packed ids by stretch; a stretch that is not there is encoded."""

    def __init__(self, owner: MergeEncoder):
        self.owner = owner

    def __missing__(self, stretch: str) -> bytes:
        return self.owner.packed_ids(stretch)


def pack(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


_ENCODERS: dict[str, MergeEncoder] = {}


def encoder(path: str) -> MergeEncoder:
    """The worker's encoder of a model file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = MergeEncoder(path)
    return _ENCODERS[path]


def checked_pieces(own: MergeEncoder, rows: pa.Array, texts: list[str]) -> tuple[list[bytes], list[str]]:
    """Packed ids and decodings of some texts; raises where the ids are not the library's."""
    ids = [own.encode(t) for t in texts]
    theirs = own.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
    for k, (a, b) in enumerate(zip(ids, theirs)):
        if a != pack(b):
            raise ValueError(f"ids differ from the library's for row {rows[k]}")
    return ids, [own.library.decode(i) for i in theirs]


def _pieces(path: str, columns, slice_: int = 128):
    """columns makes the arrays of packed ids and decodings from their lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in slices(batches, slice_):
            made = columns(*checked_pieces(own, part.column(0), [t or "" for t in part.column(1).to_pylist()]))
            yield pa.record_batch([part.column(0), *made.values()], ["row", *made])

    return run


def _lists(ids: list[bytes], decoded: list[str]) -> dict[str, pa.Array]:
    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
    values = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
    return {"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), "decoded": pa.array(decoded, pa.string())}


def _digests(ids: list[bytes], decoded: list[str]) -> dict[str, pa.Array]:
    sums = [hashlib.sha256(x).hexdigest() for x in ids]
    back = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in decoded]
    return {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids_sha256": pa.array(sums, pa.string()), "decoded_sha256": pa.array(back, pa.string())}


def _base(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("row"), F.col(text_column).cast("string").alias("text"))


def encode_texts(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of whole texts: ids with begin and end, as the library gives them, and their decoding.

    Null and empty texts have the begin and end ids only and decode to the empty text. Null ids and repeated rows pass
    through. model_path is read by each worker. A difference from the library's ids ends the job with the row's id.
    """
    return _base(docs, id_column, text_column).mapInArrow(_pieces(model_path, _lists), "row long, ids array<int>, decoded string").withColumnRenamed("row", "doc_id")


def encode_digests(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what encode_texts() gives."""
    return _base(docs, id_column, text_column).mapInArrow(_pieces(model_path, _digests), "row long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("row", "doc_id")
