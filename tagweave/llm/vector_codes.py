"""Vector code compression: product codes by Elkan's form of Lloyd's rounds, in whole numbers.

Vectors become integers, cut into equal consecutive parts; each part's place has a codebook of its
own. The first assignment measures all entries. After it each row carries, for every part, an upper
bound of the distance to its own entry and one lower bound for each entry, and both are written with
the row. When the entries have moved, the bounds are shifted by how far; a part whose upper bound is
strictly less than half the way to the next entry keeps its entry unseen, and other entries are
measured only where neither their lower bound nor the triangle inequality rules them out strictly.
What is measured is measured in integers, so ties are ties and go to the lower index.

The bounds are floating-point numbers, rounded to the safe side; a lower bound is one byte on the
part's own scale. Codebooks are a bounded number of integers; they, and nothing that grows with the
rows, pass through the driver. Sums are added up in each task before they are shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import let_go, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: What rounding may take from or add to a bound, and bytes of integers that are worked on at once.
SLACK, AT_ONCE = 1e-5, 4 << 20
#: Labels whose sums may be broadcast; more are joined by a shuffle.
FEW_LABELS = 100_000
STATE = "vec_id long, label int, vector binary, code binary, error long, upper binary, scale binary, lower binary"


def most(dim: int) -> int:
    """Integers beyond it, of either sign, are held at it, so that every squared distance fits a long."""
    return math.isqrt((1 << 62) // (4 * dim))


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    most_seen = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most_seen * most_seen * x.shape[1] < 1 << 53:  # every step is a whole number that a double holds
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], 1)


def _to_bytes(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds (rows, entries) as bytes on each row's scale, rounded down."""
    scale = (low.max(1) / 255).astype(np.float32)
    scale[scale == 0] = 1
    return np.minimum(low / scale[:, None], 255).astype(np.uint8), scale


def first_part(x: np.ndarray, entries: np.ndarray) -> tuple:
    """Assign one part of all rows by measuring every entry: (code, squared distance, upper, lower as bytes, their scale)."""
    d2 = squares(x, entries)
    code = d2.argmin(1)
    own = d2[np.arange(len(x)), code]
    return code, own, np.sqrt(own), *_to_bytes(np.sqrt(d2.astype(np.float64)))


def next_part(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, upper: np.ndarray, low: np.ndarray) -> tuple:
    """Assign one part of all rows again, after the entries have moved: as ``first_part``, and how many distances were measured."""
    upper, low = upper + moved[code], np.maximum(low - moved, 0)
    between = np.sqrt(squares(entries, entries).astype(np.float64)) / 2 * (1 - SLACK)
    apart = np.where(np.eye(len(entries), dtype=bool), np.inf, between).min(1)
    live = np.flatnonzero(upper * (1 + SLACK) >= apart[code])
    own = ((x - entries[code]) ** 2).sum(1)
    was = code[live]
    exact = np.sqrt(own[live].astype(np.float64))
    upper[live], low[live, was] = exact, exact
    reach = exact[:, None] * (1 + SLACK)
    asked = (low[live] <= reach) & (between[was] <= reach)
    asked[np.arange(len(live)), was] = False
    row, entry = np.nonzero(asked)
    d2 = ((x[live[row]] - entries[entry]) ** 2).sum(1)
    low[live[row], entry] = np.sqrt(d2.astype(np.float64))
    row, entry, d2 = (np.concatenate(p) for p in ((row, np.arange(len(live))), (entry, was), (d2, own[live])))
    order = np.lexsort((entry, d2, row))  # the nearest, of equally near ones the first
    best = order[np.searchsorted(row[order], np.arange(len(live)))]
    code, own = code.copy(), own.copy()
    code[live], own[live] = entry[best], d2[best]
    upper[live] = np.sqrt(d2[best].astype(np.float64))
    return code, own, upper, *_to_bytes(low), len(asked.nonzero()[0])


def _matrix(column, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _in_slices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    step = max(1, AT_ONCE // (8 * dim))
    for whole in batches:
        for k in range(0, whole.num_rows, step):
            yield whole.slice(k, step)


def _rows(batch: pa.RecordBatch, vectors: np.ndarray, parts: list[tuple]) -> pa.RecordBatch:
    """State rows from what each part's assignment gave."""
    cut = lambda a: pa.array([r.tobytes() for r in np.ascontiguousarray(a)], pa.binary())
    code, own, upper, low, scale = (np.stack([p[k] for p in parts], 1) for k in range(5))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("vec_id"), batch.column("label"), cut(vectors.astype(np.int32)), cut(code.astype(np.uint8)), pa.array(own.sum(1), pa.int64()),
            cut(np.nextafter(upper.astype(np.float32), np.float32(np.inf))), cut(scale), cut(low.reshape(len(low), -1)),
        ],
        ["vec_id", "label", "vector", "code", "error", "upper", "scale", "lower"],
    )


def _sums(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks with each entry replaced by the floor of the mean of the parts that chose it; unused entries stay."""
    parts, size, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, used = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in _in_slices(batches, parts * width):
            x, code = _matrix(batch.column("vector"), np.int32, parts * width), _matrix(batch.column("code"), np.uint8, parts)
            for p in range(parts):
                np.add.at(total[p], code[:, p], x[:, p * width : (p + 1) * width])
                used[p] += np.bincount(code[:, p], minlength=size)
        at = np.argwhere(used)
        kinds = [(at[:, 0], pa.int32()), (at[:, 1], pa.int32()), (used[used > 0], pa.int64()), (list(total[used > 0]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in kinds], ["part", "entry", "n", "sums"])
        let_go()

    found = state.select("vector", "code").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    found = found.select("part", "entry", "n", F.posexplode("sums").alias("place", "total"))
    out = books.copy()
    # at most as many rows as the codebooks have integers
    for r in found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r.part, r.entry, r.place] = r.total // r.n
    return out


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """Codebooks after ``rounds`` rounds, and the rows coded by them.

    Returns (rows vec_id, label, vector, code, error and the bounds; codebooks as integers by part, entry and place).
    ``vector`` holds the row's integers, floor(scale * x), as little-endian 32-bit numbers, ``code`` a byte for each part,
    ``error`` the squared distance to what the code stands for.

    Rows are left out whose vector is null or holds a null, NaN or infinite component, as are those whose length isn't the
    one of the vector of least vec_id (of the lengths that can be cut into ``parts``; null ids come last). Integers beyond
    ``most`` of that length are held at it. Codebooks start as the vectors of least vec_id; of repeated ids the lesser vector
    comes first. Fewer rows than entries make fewer entries; no rows give no rows and codebooks without entries. Ties go to
    the lower index. Null labels and ids, repeated rows and equal vectors are rows like any other; further columns aren't read.

    Of what is written the last table is read by the result; a row's bounds take 1 byte an entry and part.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is a byte for each part: 1 to 256 entries")
    held = F.col("embedding")
    sound = held.isNotNull() & ~F.exists(held, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("int").alias("label"), vectors["embedding"].cast("array<double>").alias("embedding"))
    rows = rows.where(sound & (F.size(held) > 0) & (F.size(held) % parts == 0))
    first = F.col("vec_id").asc_nulls_last(), held
    start = rows.orderBy(*first).limit(entries).collect()
    dim = len(start[0].embedding) if start else parts
    if any(len(r.embedding) != dim for r in start):
        start = rows.where(F.size(held) == dim).orderBy(*first).limit(entries).collect()
    rows, width, limit = rows.where(F.size(held) == dim), dim // parts, most(dim)
    held_at = lambda x: np.clip(np.floor(scale * x), -limit, limit).astype(np.int64)
    books = np.array([held_at(np.array(r.embedding)) for r in start], np.int64).reshape(len(start), parts, width).transpose(1, 0, 2).copy()

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_slices(batches, dim):
            x = held_at(batch.column("embedding").flatten().to_numpy(zero_copy_only=False)).reshape(-1, dim)
            yield _rows(batch, x, [first_part(x[:, p * width : (p + 1) * width], books[p]) for p in range(parts)])
        let_go()

    state, size = materialize(rows.mapInArrow(begin, STATE), "vector-codes"), len(start)
    for _ in range(rounds if start else 0):
        after = _sums(state, books)
        state, books = materialize(state.mapInArrow(_again(after, books, size), STATE), "vector-codes"), after
    return state, books


def _again(books: np.ndarray, before: np.ndarray, size: int):
    """Assign the rows of a state by ``books``, which were ``before``."""
    parts, _, width = books.shape
    moved = np.sqrt(((books - before) ** 2).sum(2).astype(np.float64)) * (1 + SLACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_slices(batches, parts * width):
            x = _matrix(batch.column("vector"), np.int32, parts * width).astype(np.int64)
            code, upper = _matrix(batch.column("code"), np.uint8, parts).astype(np.int64), _matrix(batch.column("upper"), np.float32, parts).astype(np.float64)
            low = _matrix(batch.column("lower"), np.uint8, parts * size).reshape(-1, parts, size)
            low = low * _matrix(batch.column("scale"), np.float32, parts).astype(np.float64)[:, :, None] * (1 - SLACK)
            yield _rows(batch, x, [next_part(x[:, p * width : (p + 1) * width], books[p], moved[p], code[:, p], upper[:, p], low[:, p])[:5] for p in range(parts)])
        let_go()

    return run


def digests(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (of equal labels together, nulls too), codebooks_sha256."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    sums = materialize(sums, "label-errors")
    sums = F.broadcast(sums) if sums.count() <= FEW_LABELS else sums
    print_ = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = coded.select("vec_id", "label", "code", "error").join(sums, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(print_).alias("codebooks_sha256"))
