"""What the operators of this subpackage share: the shared folder, barriers, Arrow buffers, components.

No function here looks at file systems with Python: tables go through Spark's own
readers and writers, so that any store that only Spark can reach will do.
"""

from __future__ import annotations

import atexit
import ctypes
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that ends a word, as a Java, Python and RE2 class body.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; one of our own where that is unset and Spark is local."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set: no folder is known that driver and executors share")
        found = "file://" + (own := tempfile.mkdtemp(prefix="tagweave-"))
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    for tables in _noted:
        tables.append(out)
    return out


_noted: list[list[DataFrame]] = []


@contextmanager
def written_tables() -> Iterator[list[DataFrame]]:
    """The tables that ``materialize`` writes inside the block: for whoever has read all that they are for, to discard them."""
    _noted.append([])
    try:
        yield _noted[-1]
    finally:
        _noted.pop()


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialize`` wrote for the frames; only once nothing that is still to run reads it."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_text(df: DataFrame, column: str = "text") -> Column:
    """The text column as a string, null as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions may use many times but Spark works out once a row.

    A one-element Generate stands between the projections, so the optimizer can't
    copy a costly expression into lambdas that run for each element of an array.
    """
    fields = F.struct(*[c.alias(k) for k, c in columns.items()])
    return df.select("*", F.inline(F.array(fields)))


def folded(items: Column, zero: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], merge: Callable[[Column, Column], Column], few: int = 64) -> Column:
    """``emit(state, x)`` of every item x, the state being what ``step`` has made of ``zero`` with the items before x.

    A fold copies its list of results for each one that it adds. So longer arrays are folded in blocks of about the square
    root of their length, each from the state that ``merge`` gives of the blocks before. ``step(s, x)`` must be the
    same as ``merge(s, step(zero, x))``. ``items`` is worked out several times: a column, not a costly expression.
    """

    def let(value: Column, of: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), of), 0)  # worked out once, however often ``of`` uses it

    def whole(block: Column, state: Column) -> Column:
        kind = F.transform(F.filter(block, lambda x: F.lit(False)), lambda x: emit(zero, x))  # the type of no results
        begun = F.struct(state.alias("state"), kind.alias("out"))
        put = lambda at, x: F.struct(step(at["state"], x).alias("state"), F.array_append(at["out"], emit(at["state"], x)).alias("out"))
        return F.aggregate(block, begun, put, lambda at: at["out"])

    length = F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(few)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / length).cast("int")), lambda k: F.slice(items, k * length + 1, length))
    totals = lambda cut: F.transform(cut, lambda block: F.aggregate(block, zero, step))
    each = lambda cut, sums: F.transform(cut, lambda block, k: whole(block, F.aggregate(F.slice(sums, 1, k), zero, merge)))
    in_blocks = let(blocks, lambda cut: let(totals(cut), lambda sums: F.flatten(each(cut, sums))))
    return F.when(F.size(items) <= few, whole(items, zero)).otherwise(in_blocks)


def string_buffer(array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array without nulls, and the offsets of its values in them."""
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    kind = np.int64 if "large" in str(array.type) else np.int32
    at = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def slices(batch, column: str, most_bytes: int = 8 << 20):
    """Cut a record batch into runs of rows whose ``column`` holds about ``most_bytes`` at most (one row at least)."""
    _, at = string_buffer(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(at, at[start] + most_bytes, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


class Kept:
    """Results of costly work on words, of bounded size: two generations, of which the older goes.

    Words that keep coming back move to the new generation, so only rare ones are worked on again.
    What a batch needs is all there at once, however much it is; batches are bounded by their readers.
    """

    #: Bytes that an entry takes beside its word and result.
    ENTRY = 200

    def __init__(self, most_bytes: int):
        self.most_bytes, self.held = most_bytes, 0
        self.now: dict = {}
        self.before: dict = {}

    def fill(self, words: set, work, at_once: int = 20_000) -> None:
        """Have ``now`` hold all of ``words``; ``work`` gives the results (numbers or bytes) of a list of them."""
        new = words.difference(self.now)
        if new and self.held > self.most_bytes:
            self.before, self.now, self.held, new = self.now, {}, 0, words
        known = self.before.keys() & new
        self._keep(known, list(map(self.before.__getitem__, known)))
        unknown = list(new - known)
        for k in range(0, len(unknown), at_once):
            part = unknown[k : k + at_once]
            self._keep(part, work(part))

    def _keep(self, words, found: list) -> None:
        self.now.update(zip(words, found, strict=True))
        self.held += self.ENTRY * len(found) + sum(map(len, words)) + (sum(map(len, found)) if found and isinstance(found[0], bytes) else 0)


def let_go() -> None:
    """At a task's end: give memory that is free again back to the system, as a worker may wait long for its next task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another system's library: its own business
        pass


@contextmanager
def one_thread() -> Iterator[None]:
    """Inside, the tokenizers library starts no threads of its own: for small batches, where handing out costs more than it brings."""
    before = os.environ.get("TOKENIZERS_PARALLELISM")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    try:
        yield
    finally:
        if before is None:
            del os.environ["TOKENIZERS_PARALLELISM"]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = before


def few_threads() -> None:
    """Before the tokenizers library starts its threads: two in a worker; the tasks are what runs in parallel."""
    os.environ.setdefault("RAYON_NUM_THREADS", "2")


#: Rows of a small table that one task writes: fewer files, where Spark would have as many as partitions.
ROWS_A_FILE = 500_000


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (a, b): rows (node, component), the smallest node reachable.

    Alternating large-star and small-star steps: each node keeps pointing at ever
    smaller nodes, so that the number of edges doesn't grow and long chains take a
    logarithmic number of rounds. Every round is written to the shared folder, and what the
    round before wrote is deleted. A hub's least neighbour comes from an aggregation; its
    neighbours then meet that one row in a join whose hot keys Spark can split.

    The result reads a table that ``discard`` deletes once it isn't needed. No edges give no rows.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())

    def kept(df: DataFrame, rows: int) -> DataFrame:
        return materialize(df.coalesce(8 + rows // ROWS_A_FILE), "edges")

    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    current = materialize(pairs, "edges")
    before = state(current)
    for _ in range(rounds):
        if not before[0]:
            break
        both = current.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(current.select("lo", "hi"))
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least"))
        large = both.where("m > n").join(least, "n").select(F.col("m").alias("hi"), F.col("least").alias("lo"))
        large = kept(large, before[0])  # as many rows as edges
        small = large.groupBy("hi").agg(F.min("lo").alias("least"))
        linked = large.join(small, "hi").select(
            F.inline(
                F.array(
                    F.struct(F.greatest("lo", "least").alias("hi"), F.col("least").alias("lo")),
                    F.struct(F.col("hi"), F.col("least").alias("lo")),
                )
            )
        )
        after = kept(linked.where("hi <> lo").distinct(), before[0])
        discard(large, current)
        current, last, before = after, before, state(after)
        if before == last:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    out = current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
    out._written_at = current._written_at
    return out
