"""Best-fit packing by hierarchical residuals.

Documents become token ids, cut into pieces only where they are longer than a sequence. Pieces
are packed best-fit, longest first, in units of one partition's rows; bins that are nearly full
about a piece of half a sequence or more are done: short pieces stay what gaps are filled with anywhere. What is left of the units goes up, added up by length: however many pieces are left
anywhere, there are no more lengths than tokens in a sequence. A second best-fit round packs these
counts, longest first, as if all pieces that are left stood in one unit, and says which of the pieces of a
length, by their number, go where. Pieces are numbered in their unit, and units by running sums, so
no task holds more than a unit, and the driver no more than two numbers for each length.

Underfull bins go up as their pieces. As bins they couldn't be mended: where all long pieces are in some
partitions and all short ones in others, the short ones would stay among themselves, whatever the rounds.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import Kept, few_threads, let_go, materialize, one_thread, slices, whole_text
from tagweave.llm.merging import RankMerger

PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]
PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, unit bigint, sequence_id bigint, offset bigint, number bigint"
#: Pieces of a unit. A bin is nearly full if this share of it, or less, is free.
UNIT, NEARLY_FULL = 100_000, 1 / 256
#: Numbers of sequences: those of the first round hold the unit, those of the second start here.
SECOND_ROUND = 1 << 62
#: Bytes of words and their ids that are kept in each Python worker, and as many from before.
MOST_KEPT = 48 << 20
#: The pre-tokenizer's pattern for which plain words are known to be cut as they are here.
CUT_LIKE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of plain Latin letters, with ASCII marks after the last perhaps: the tokenizer always cuts between a letter and
#: a run of marks, and has nothing to normalise here but the case.
PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*)([.,*$%&#|!?;:)]*)")


class WordEncoder:
    """Ids of texts under a byte-level BPE tokenizer that drops white space and never reaches across it, word by word.

    Plain words are merged many at a time by the tokenizer's own table of merges; all others, and every word if the
    tokenizer isn't of the kind that this is known to be right for, go through the library.
    """

    def __init__(self, tokenizer_json: str):
        few_threads()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.ids = Kept(MOST_KEPT)
        spec = json.loads(tokenizer_json)
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        normal = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        cut = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        cut = [(x["type"], x.get("pattern"), x.get("invert"), x.get("use_regex"), x.get("add_prefix_space")) for x in cut]
        self.plain = (
            model["type"] == "BPE" and suffix != "" and not model.get("dropout") and not model.get("ignore_merges")
            and normal == ["NFC", "Replace", "Lowercase"]
            and cut == [("Split", {"Regex": CUT_LIKE}, True, None, None), ("ByteLevel", None, None, False, False)]
        )
        if self.plain:
            vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
            left, right, made = ([vocab[f(m)] for m in merges] for f in (lambda m: m[0], lambda m: m[1], "".join))
            self.merger = RankMerger(left, right, made, list(range(len(merges))), len(vocab))
            # byte-level vocabularies write the printable bytes as themselves and the others from U+0100 on
            shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
            names = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in shown)}
            self.inner, self.final = (np.array([vocab[names[b] + end] for b in range(256)], np.int32) for end in ("", suffix))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each UTF-8 text."""
        split = [t.split() for t in texts]  # bytes: ASCII white space only
        self.ids.fill(set().union(*split), self.encode_words, 100_000)
        get = self.ids.now.__getitem__
        for words in split:
            yield b"".join(map(get, words))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word."""
        found = [PLAIN.fullmatch(w) if self.plain else None for w in words]
        other = [w for w, m in zip(words, found, strict=True) if m is None]
        by_library: list[bytes] = []
        for k in range(0, len(other), 5_000):
            with one_thread():
                batch = self.tokenizer.encode_batch_fast([w.decode() for w in other[k : k + 5_000]], add_special_tokens=False)
            by_library += [np.array(e.ids, "<u4").tobytes() for e in batch]
        if len(other) == len(words):
            return by_library
        # the letters and the marks of each word are a sequence each; empty ones are none
        sequences = [s for m in found if m is not None for s in m.groups()]
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        data = np.frombuffer(b"".join(sequences), np.uint8).copy()
        capital = (data >= 65) & (data <= 90)
        capital[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        data[capital] += 32
        symbols = self.inner[data]
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbols[ends] = self.final[data[ends]]
        survivors, part = self.merger.merge(symbols, np.repeat(np.arange(len(sequences), dtype=np.int32), lengths))
        at = (4 * np.searchsorted(part, np.arange(0, len(sequences) + 1, 2))).tolist()
        raw = survivors.astype("<u4").tobytes()
        merged = iter([raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)])
        rest = iter(by_library)
        return [next(rest) if m is None else next(merged) for m in found]


_encoders: dict[str, WordEncoder] = {}


def pieces(docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids and a last id 0, cut at ``capacity``.

    Null and empty texts are one piece of one id; null doc_ids and repeated rows are cut like any other; no rows give
    none; other columns aren't read, whatever their names. A worker holds a slice of a batch (4 MB of text, or one
    longer text) with its ids, and MOST_KEPT bytes of words and ids, twice.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())  # a file of a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held.value not in _encoders:
            _encoders.clear()
            _encoders[held.value] = WordEncoder(held.value)
        encoder = _encoders[held.value]
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                out: list[tuple] = []
                texts = [x.as_buffer().to_pybytes() if len(x.as_buffer()) else b"" for x in batch.column("text").cast(pa.binary())]
                for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    ids += bytes(4)
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        out.append((doc, n, at // 4, len(own) // 4, zlib.crc32(own)))
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])
        let_go()

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), whole_text(docs, text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that still has room.

    Bins are kept by their free room; a bit set of the rooms there are finds the best fit at once.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        if fit := rooms >> n:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - n
        by_room[left].append(b)
        rooms |= 1 << left
    return bins


def best_fit_by_length(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """``best_fit`` over so many pieces of each length, without the pieces: (rows, number of sequences).

    A row (length, low, high, sequence, each, offset) places the pieces of a length numbered from low to below high:
    number k is in sequence ``sequence + (k - low) // each``, at ``offset + (k - low) % each * length``. Sequences
    alike are worked on together, so there are a few rows for each length, whatever the counts.
    """
    alike: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by free room: (first sequence, how many)
    rooms, made, rows = 0, 0, []

    def free(room: int, first: int, many: int) -> None:
        nonlocal rooms
        if many:
            alike[room].append((first, many))
            rooms |= 1 << room

    for n in sorted(counts, reverse=True):
        low, high = 0, counts[n]
        while low < high:
            if fit := rooms >> n:
                room = n + (fit & -fit).bit_length() - 1
                first, many = alike[room].pop()
                if not alike[room]:
                    rooms ^= 1 << room
            else:
                room, first, many = capacity, made, -(-(high - low) // (capacity // n))
                made += many
            each = room // n
            full = min(many, (high - low) // each)
            if full:
                rows.append((n, low, low + full * each, first, each, capacity - room))
                low += full * each
                free(room - each * n, first, full)
            if full < many and low < high:
                rows.append((n, low, high, first + full, high - low, capacity - room))
                free(room - (high - low) * n, first + full, 1)
                full, low = full + 1, high
            free(room, first + full, many - full)
    return rows, made


def _unit(number: int, batches: list[pa.RecordBatch], capacity: int) -> pa.RecordBatch:
    """Pack a unit: pieces of nearly full bins get their place, all others a number among those of their length."""
    table = pa.Table.from_batches(batches)
    lengths = table["length"].to_numpy()
    sequence, offset, held = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64), lengths.tolist()
    for k, own in enumerate(best_fit(held, capacity)):
        sizes = [held[i] for i in own]
        if 2 * sizes[0] >= capacity and capacity - sum(sizes) <= capacity * NEARLY_FULL:
            sequence[own], offset[own] = (number << 17) + k, np.cumsum([0, *sizes[:-1]])
    left = np.flatnonzero(sequence < 0)
    order = left[np.argsort(lengths[left], kind="stable")]
    _, first, times = np.unique(lengths[order], return_index=True, return_counts=True)
    numbers = np.zeros(len(lengths), np.int64)
    numbers[order] = np.arange(len(order)) - np.repeat(first, times)
    none = sequence < 0
    more = [pa.array(np.full(len(lengths), number)), pa.array(sequence, mask=none), pa.array(offset, mask=none), pa.array(numbers, mask=~none)]
    columns = [table[c].combine_chunks() for c in PIECE] + more
    return pa.RecordBatch.from_arrays(columns, [*PIECE, "unit", "sequence_id", "offset", "number"])


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """Pack rows of ``pieces`` into as few sequences of ``capacity`` as best fit does; adds sequence_id and offset to each piece.

    Offsets are gapless from 0 in each sequence. Null or empty texts are pieces of one id; null doc_ids and
    repeated rows are packed like any other; no rows give no sequences. Texts don't come here at all. Two tables are
    written, which the result reads.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        unit, held, count = TaskContext.get().partitionId() << 16, [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, UNIT):
                part = batch.slice(k, UNIT)
                if count + part.num_rows > UNIT:
                    yield _unit(unit, held, capacity)
                    unit, held, count = unit + 1, [], 0
                held.append(part)
                count += part.num_rows
        if count:
            yield _unit(unit, held, capacity)
        let_go()

    placed = materialize(cut.select(*PIECE).mapInArrow(first, PLACED), "placed")
    left = placed.where("sequence_id is null")
    before = Window.partitionBy("length").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    counts = left.groupBy("length", "unit").agg(F.count("*").alias("pieces"))
    counts = materialize(counts.withColumn("before", F.coalesce(F.sum("pieces").over(before), F.lit(0))), "lengths")
    # as many rows as lengths
    totals = {r.length: r.pieces for r in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    rows, _ = best_fit_by_length(totals, capacity)
    plan = cut.sparkSession.createDataFrame(rows, "of long, low long, high long, first long, each long, at long")
    # a few rows for each length
    numbered = left.join(counts.select(F.col("length").alias("l"), F.col("unit").alias("u"), "before"), (F.col("length") == F.col("l")) & (F.col("unit") == F.col("u")))
    numbered = numbered.withColumn("k", F.col("before") + F.col("number"))
    found = numbered.join(F.broadcast(plan), (F.col("length") == F.col("of")) & (F.col("k") >= F.col("low")) & (F.col("k") < F.col("high")))
    nth = F.col("k") - F.col("low")
    sequence = F.lit(SECOND_ROUND) + F.col("first") + F.floor(nth / F.col("each"))
    found = found.select(*PIECE, sequence.cast("long").alias("sequence_id"), (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"))
    return placed.where("sequence_id is not null").select(*PIECE, "sequence_id", "offset").union(found)
