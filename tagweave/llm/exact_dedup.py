"""Exact dedup by content-defined chunk recipes.

Texts are normalised (each run of white space becomes one space) and cut into chunks where
a windowed hash of the content says so, so that equal passages give equal chunks wherever
they stand. Chunks become identifiers: their 128-bit digest, verified by comparing the bytes
of all chunks that share it. Documents are then equal if their ordered identifier lists are;
from there on only the lists move, never the texts again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import let_go, materialize, slices, string_buffer, whole_text

SCHEMA = "doc_id long, text_sha256 string, recipe binary, chunks array<struct<digest: binary, body: binary>>"
#: Chunk sizes in bytes: none but a text's last is under LEAST, none over MOST, and cuts come about every 2 ** BITS.
LEAST, MOST, BITS = 512, 16_384, 11


def _gear() -> np.ndarray:
    """256 pseudo-random words by the splitmix64 rule."""
    with np.errstate(over="ignore"):
        z = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def squeeze(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace each white-space run inside each text by one space; returns bytes and offsets."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    again = np.zeros(len(data), bool)
    again[1:] = white[1:] & white[:-1]
    again[at[:-1][at[:-1] < len(data)]] = False  # a run doesn't cross texts
    out = np.where(white, np.uint8(32), data)
    removed = np.flatnonzero(again)
    if not len(removed):
        return out, at
    return out[~again], at - np.searchsorted(removed, at, "left")


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places after which content says to cut: the last 16 bytes decide, whatever stands before them."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h = more
    return np.flatnonzero((h >> np.uint32(32 - BITS)) == 0) + 1


def chunk_bounds(places: np.ndarray, start: int, end: int) -> list[int]:
    """Bounds of the chunks of the text at [start, end): content cuts, with the size limits."""
    out, last = [start], start
    inner = places[np.searchsorted(places, start + LEAST) : np.searchsorted(places, end)]
    for p in inner.tolist():
        while p - last > MOST:
            last += MOST
            out.append(last)
        if p - last >= LEAST:
            out.append(p)
            last = p
    while end - last > MOST:
        last += MOST
        out.append(last)
    if end > last or len(out) == 1:
        out.append(end)
    return out


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 2 << 20):
            data, at = squeeze(*string_buffer(batch.column("text")))
            places, raw = cut_places(data), data.tobytes()
            shas, recipes, digests, bodies, counts = [], [], [], [], [0]
            for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                shas.append(hashlib.sha256(raw[start:end]).hexdigest())
                bounds = chunk_bounds(places, start, end)
                own = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                ids = [hashlib.blake2b(x, digest_size=16).digest() for x in own]
                recipes.append(b"".join(ids))
                digests += ids
                bodies += own
                counts.append(len(digests))
            chunks = pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(bodies, pa.binary())], ["digest", "body"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shas, pa.string()), pa.array(recipes, pa.binary()), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), chunks)],
                ["doc_id", "text_sha256", "recipe", "chunks"],
            )
    let_go()


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Group rows whose texts are equal after squeezing white space.

    Returns one row for each row of ``docs``: doc_id, keep_id (the smallest doc_id of its group),
    group_size, kept (doc_id = keep_id), text_sha256 (of the normalised text).

    Null texts count as empty; empty texts form a group. A null doc_id is never kept unless its whole
    group has none (then keep_id is null and kept true). Rows that repeat both id and text are each
    counted and share their verdict. No rows give no rows; other columns aren't read, whatever their names. Very long
    texts are chunked like any other; a worker holds a slice of a batch (2 MB of text, or one longer text) and some
    twenty bytes for each of its bytes.

    A chunk digest that two different bodies share (none is known to exist) is found by the byte
    comparison; documents with such a chunk are then compared by their bodies as well.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), whole_text(docs, text_column).alias("text"))
    table = materialize(rows.mapInArrow(_recipes, SCHEMA), "recipes")

    chunks = table.select(F.inline("chunks"))
    same = chunks.groupBy("digest").agg(F.min("body").alias("least"), F.max("body").alias("most"))
    shared = materialize(same.where("least <> most").select("digest"), "clashes")

    lists = table.select("doc_id", "text_sha256", F.col("recipe").alias("ids"))
    if not shared.isEmpty():
        hit = F.explode(F.col("chunks.digest")).alias("digest")
        recipes = table.select("recipe", hit).join(shared, "digest", "left_semi").select("recipe").distinct()
        hit = table.join(recipes, "recipe", "left_semi")
        bodies = F.aggregate("chunks.body", F.lit("").cast("binary"), lambda a, b: F.concat(a, b))
        hit = hit.select("doc_id", "text_sha256", F.concat("recipe", bodies).alias("ids"))
        lists = table.join(recipes, "recipe", "left_anti").select("doc_id", "text_sha256", F.col("recipe").alias("ids")).union(hit)
    groups = lists.groupBy("ids").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # read back, so that both sides of the join are dealt by Spark and a hot group can be split
    groups = materialize(groups, "groups")
    return lists.join(groups, "ids").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
