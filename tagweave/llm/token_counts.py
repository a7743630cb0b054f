"""Token counts by rank-synchronous merging.

Texts are cut into pre-tokens that no piece of the vocabulary can reach across. The pre-tokens
of a batch that haven't been seen yet stand one after the other in ragged numpy arrays; each
round applies to every sequence, at once, its lowest-rank pair (the leftmost of equals), until
no sequence has a pair that is a piece. The symbols that survive are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import Kept, slices, whole_text
from tagweave.llm.merging import NEVER, RankMerger

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MARK = "▁"
#: Bytes of pre-tokens and their counts that are kept in each Python worker, and as many from before.
MOST_KEPT = 64 << 20


class PieceCounter:
    """Counts the tokens of texts under a BPE model with byte fallback, as its own library would."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        norm, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with byte fallback and without user-defined or unused pieces are counted")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave texts as they are but for marked spaces are counted")
        self.prefix = norm.add_dummy_prefix
        pieces = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds a space after other characters")
        self.newline_alone = not any("\n" in p for p in pieces)
        # lower rank, earlier merge; equal scores have equal ranks, and the leftmost goes first
        ranks = {s: n for n, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        chars = {c for p in pieces for c in p}
        names = [*pieces, *sorted(chars - pieces.keys())]
        self.ids = {p: n for n, p in enumerate(names)}
        self.unknown = len(names)
        self.char_id = np.full(0x110000, self.unknown, np.int32)
        for c in chars:
            self.char_id[ord(c)] = self.ids[c]
        # a symbol that is no piece (a lone character) falls back to its UTF-8 bytes; the unknown one is weighed by its own
        self.weight = np.array([1 if p in pieces else len(p.encode()) for p in names] + [0], np.int64)
        left, right, made, rank = [], [], [], []
        for p, score in pieces.items():
            for k in range(1, len(p)):
                if (a := self.ids.get(p[:k])) is not None and (b := self.ids.get(p[k:])) is not None:
                    left.append(a)
                    right.append(b)
                    made.append(self.ids[p])
                    rank.append(ranks[score])
        self.merger = RankMerger(left, right, made, rank, self.unknown + 1)
        beside = {self.ids[p[k]] * (self.unknown + 1) + self.ids[p[k + 1]] for p in pieces for k in range(len(p) - 1)}
        #: Pairs of characters that stand side by side in some piece.
        self.beside = np.array(sorted(beside), np.int64)
        self.counts = Kept(MOST_KEPT)

    def count_sequences(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(words), np.int64)
        if not words:
            return out
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.char_id[code]
        of = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        lost = symbols == self.unknown
        if lost.any():  # never merged: count their bytes now
            c = code[lost]
            np.add.at(out, of[lost], 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF).astype(np.int64))
        rank = self.merger.ranks(symbols, of)
        # where no piece has two neighbours side by side, no merge reaches across: shorter sequences
        cut = np.ones(len(code), bool)
        cut[1:] = rank[:-1] == NEVER
        cut[1:] &= (of[:-1] != of[1:]) | ~self._beside(symbols[:-1], symbols[1:])
        survivors, part = self.merger.merge(symbols, np.cumsum(cut, dtype=np.int32) - 1, rank)
        np.add.at(out, of[cut][part], self.weight[survivors])
        return out

    def _beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) * (self.unknown + 1) + b
        at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
        return self.beside[at] == keys

    def pretokens(self, text: str) -> Iterator[list[str]]:
        """Lists of pre-tokens that make up the text with its spaces marked, line by line where no piece holds a line's end."""
        text = text.replace(" ", MARK)
        if self.prefix and text:
            text = MARK + text
        for line in text.split("\n") if self.newline_alone else [text]:
            if MARK + MARK in line:  # a run of marks goes with the word after it
                words, held = [], ""
                for w in line.split(MARK):
                    if w or not words and not held:
                        words.append(held + w)
                        held = MARK
                    else:
                        held += MARK
                yield [*words, held[1:]]  # a mark stands between two of what the split gives: one less than was held
            else:
                first, *rest = line.split(MARK)
                yield [first, *[MARK + w for w in rest]]

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [list(self.pretokens(t)) for t in texts]
        self.counts.fill(set().union(*[w for lines in split for w in lines]), lambda words: self.count_sequences(words).tolist(), 200_000)
        get = self.counts.now.__getitem__
        return [len(lines) - 1 + sum(sum(map(get, words)) for words in lines) if lines else 0 for lines in split]


_counters: dict[bytes, PieceCounter] = {}


def count_tokens(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 4096) -> DataFrame:
    """Count the tokens of every whole text; one row for each row of ``docs``.

    Args:
        model_file: a sentencepiece BPE model on the driver; its bytes (some hundred KB) go to the workers.
        limit: n_tokens above this sets over_limit.

    Returns doc_id, n_bytes (UTF-8), n_tokens, over_limit. Null and empty texts have no bytes and no tokens.
    Null ids, ties and repeated rows are counted like any other; no rows give no rows; other columns aren't read,
    whatever their names. Texts of any length are counted whole. No shuffle; a worker holds a slice of a batch
    (4 MB of text, or one longer text) with its pre-tokens, and MOST_KEPT bytes of counts, twice.
    """
    with open(model_file, "rb") as f:
        model = f.read()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held.value not in _counters:
            _counters.clear()
            _counters[held.value] = PieceCounter(held.value)
        counter = _counters[held.value]
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                counts = counter.count_all(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = whole_text(docs, text_column)
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
