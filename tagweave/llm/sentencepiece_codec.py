"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed and the same tokenizer rebuilt there: its normaliser, the
metaspace mark, unigram scores or the merges that BPE scores stand for, and byte fallback.
Distinct pre-tokens of a batch are encoded at once, multithreaded, by the rebuilt tokenizer, and
decoded again by its decoder: those ids and texts are the result. The sentencepiece library
encodes them too, only to verify parity; pre-tokens on which it differs are counted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import Kept, few_threads, slices, whole_text

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"
#: Bytes of pre-tokens and their ids that are kept in each Python worker, and as many from before.
MOST_KEPT = 40 << 20
SCHEMA = "doc_id long, n_tokens long, ids binary, ids_crc32 long, round_trip boolean, mismatches long"


def rebuild(model: bytes):
    """A tokenizers.Tokenizer that encodes as the sentencepiece model does."""
    few_threads()
    from sentencepiece import sentencepiece_model_pb2
    from tokenizers import Tokenizer, decoders, models, normalizers

    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    norm, kind = proto.normalizer_spec, proto.trainer_spec.model_type
    names = [p.piece for p in proto.pieces]
    unknown = next((n for n, p in enumerate(proto.pieces) if p.type == UNKNOWN), None)
    fallback = proto.trainer_spec.byte_fallback
    if kind == UNIGRAM:
        body = models.Unigram([(p.piece, p.score) for p in proto.pieces], unk_id=unknown, byte_fallback=fallback)
    elif kind == BPE:
        usable = {p.piece: (p.score, n) for n, p in enumerate(proto.pieces) if p.type in (NORMAL, USER)}
        merges = []
        for piece, (score, n) in usable.items():
            splits = [(piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in usable and piece[k:] in usable]
            merges += [(-score, n, s) for s in sorted(splits, key=lambda s: (usable[s[0]][1], usable[s[1]][1]))]
        merges = [s for _, _, s in sorted(merges, key=lambda m: m[:2])]
        named = None if unknown is None else names[unknown]
        body = models.BPE({p: n for n, p in enumerate(names)}, merges, unk_token=named, fuse_unk=not fallback, byte_fallback=fallback)
    else:
        raise ValueError("only unigram and BPE models are rebuilt")
    out, steps = Tokenizer(body), []
    if norm.precompiled_charsmap:
        steps.append(normalizers.Precompiled(norm.precompiled_charsmap))
    if norm.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(" {2,}", " ")]
    if norm.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if norm.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        out.normalizer = normalizers.Sequence(steps)
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return out


class Codec:
    """Encodes and decodes batches of texts; keeps the ids of distinct pre-tokens."""

    def __init__(self, model: bytes):
        few_threads()
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        norm = proto.normalizer_spec
        self.prefix, self.trims = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        # texts can be cut before a space if nothing that spans one exists and nothing rewrites the text
        self.cuts = (
            proto.trainer_spec.model_type == BPE and norm.escape_whitespaces and not (norm.remove_extra_whitespaces or norm.precompiled_charsmap)
            and not any(MARK in p.piece.lstrip(MARK) for p in proto.pieces if p.type != CONTROL)
        )
        if self.cuts:  # the space before a text is put there once, not before each part
            norm.add_dummy_prefix = False
            model = proto.SerializeToString()
        self.tokenizer, self.library = rebuild(model), sentencepiece.SentencePieceProcessor(model_proto=model)
        self.line_cuts = self.cuts and not any("\n" in p.piece for p in proto.pieces)
        self.ids = Kept(MOST_KEPT)
        #: Pre-tokens of this batch and those kept that the library encodes otherwise, and that don't decode to themselves.
        self.differ: set[str] = set()
        self.lost: set[str] = set()

    def parts(self, text: str) -> list[str]:
        """Pre-tokens that make up the text: a run of spaces goes with the word after it."""
        if not self.cuts:
            return [text]
        out, text = [], text.replace(MARK, " ")
        if self.prefix and text:
            text = " " + text
        for n, line in enumerate(text.split("\n") if self.line_cuts else [text]):
            if n:
                out.append("\n")
            if "  " in line:
                held = ""
                for k, w in enumerate(line.split(" ")):
                    held += " " if k else ""
                    if w:
                        out.append(held + w)
                        held = ""
                out += [held] if held else []
            else:
                first, *rest = line.split(" ")
                out += [first] if first else []
                out += [" " + w for w in rest]
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, int, bool]]:
        """(little-endian 32-bit ids, pre-tokens where the library differs, whether decoding gives the text back) of each text."""
        split = [self.parts(t) for t in texts]
        words = set().union(*split)
        self.ids.fill(words, self.encode_parts)
        for noted in (self.differ, self.lost):
            noted.difference_update([p for p in noted if p not in self.ids.now and p not in self.ids.before])
        get, odd = self.ids.now.__getitem__, not (words.isdisjoint(self.differ) and words.isdisjoint(self.lost))
        for parts in split:
            differ = sum(p in self.differ for p in parts) if odd else 0
            yield b"".join(map(get, parts)), differ, not odd or self.lost.isdisjoint(parts)

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each pre-token by the rebuilt tokenizer; notes which the library encodes otherwise, or don't come back."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        for part, own, other in zip(parts, ids, self.library.encode(parts, num_threads=2), strict=True):
            if own != other:
                self.differ.add(part)
        # pre-tokens hold whole characters, so they can be decoded one by one
        for part, back in zip(parts, self.tokenizer.decode_batch(ids, skip_special_tokens=False), strict=True):
            if (back if self.cuts else self._unprefixed(back)) != part.replace(MARK, " "):
                self.lost.add(part)
        return [np.array(own, "<u4").tobytes() for own in ids]

    def _unprefixed(self, text: str) -> str:
        return text[1:] if self.prefix and text[:1] == " " else text

    def decode(self, ids: list[bytes]) -> list[str]:
        """The texts that lists of ids stand for."""
        whole = self.tokenizer.decode_batch([np.frombuffer(x, "<u4").tolist() for x in ids], skip_special_tokens=False)
        return [self._unprefixed(t) for t in whole]


_codecs: dict[bytes, Codec] = {}


def _codec(model: bytes) -> Codec:
    if model not in _codecs:
        _codecs.clear()
        _codecs[model] = Codec(model)
    return _codecs[model]


def encode(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every whole text and decode it again; one row for each row of ``docs``.

    Returns doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit, of the rebuilt tokenizer), ids_crc32,
    round_trip (decoding gives the text back, where a mark that stood in it reads as a space) and mismatches
    (pre-tokens that the sentencepiece library encodes otherwise; 0 where parity holds).

    Null and empty texts have no ids, no mismatches and a true round_trip. Null ids, ties and repeated rows are
    encoded like any other; no rows give no rows; other columns aren't read, whatever their names. A worker holds
    one slice of a batch (4 MB of text, or one longer text) with its pre-tokens, and MOST_KEPT bytes of ids, twice.
    No shuffle.
    """
    with open(model_file, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())  # some hundred KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held.value)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                out = []
                for ids, differ, back in codec.encode(batch.column("text").to_pylist()):
                    out.append((len(ids) // 4, ids, zlib.crc32(ids), back, differ))
                kinds = [pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids", "ids_crc32", "round_trip", "mismatches"])

    return docs.select(docs[id_column].cast("long").alias("doc_id"), whole_text(docs, text_column).alias("text")).mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, model_file: str, ids_column: str = "ids") -> DataFrame:
    """Add ``text``, what ``ids_column`` decodes to, by the rebuilt tokenizer's decoder; null ids give a null text, none an empty one."""
    with open(model_file, "rb") as f:
        held = encoded.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("string")
    def text_of(ids):
        out, known = ids.astype(object), ids.notna()
        out[known] = _codec(held.value).decode(ids[known].tolist())
        return out.where(known, None)

    return encoded.withColumn("text", text_of(ids_column))
