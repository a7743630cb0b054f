"""N-gram Jaccard join by a blocked sparse product of the document by n-gram incidence matrix with itself.

Rows of the matrix are distinct shingle sets, columns are n-grams. Two sets of sizes n and m can only
be linked if they share ``need`` = ceil(percent * (n + m) / (100 + percent)) n-grams, so they share one of the
first n - ceil(percent * n / 100) + 1 of each in any one order of all n-grams. Only these entries of
a row are multiplied. The order puts rare n-grams first: a table of a fixed number of counters, into which all sets
are counted, gives an n-gram's class, and its hash decides within a class. Any order gives the same result; this one keeps
columns short.

Columns are dealt into blocks by hash, and a task multiplies a block: every two rows of a short
column whose sizes and places in the order allow a link add one to their overlap. Spark adds the overlaps of the blocks
up, and pairs go whose overlap, with all that may still lie beyond what was multiplied, is less than
``need``. The rows of a long column, of which there are few, are multiplied with one another in tiles of rows,
by all of their entries, and a tile passes on no more than a spanning forest of the links it leaves: first each row's
first two long columns, then those columns that still join different components. So copies by the thousand
make a number of links in proportion to their number.

What is left are candidates; their components are verified on the full sets, from the texts. No link is lost on the way.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import components, discard, let_go, materialize, slices, string_buffer, whole_text
from tagweave.llm.near_dedup import exact_groups, shingle_sets

PERCENT, WIDTH = 85, 4
#: Counters of n-grams, 2 ** COUNTER_BITS of them at any size of the input, added up in so many tasks; a class is 4 * log2(count).
COUNTER_BITS, COUNTER_TASKS = 22, 64
#: Columns of more rows are long. Columns whose counter stands so far over twice the mean are taken for long beforehand, so
#: that no block holds them.
LONG, SURELY_LONG = 48, 16_384
#: Entries of the matrix in a block of columns, and blocks at least; rows on a side of a tile, and columns that it multiplies at once.
BLOCK, LEAST_BLOCKS, TILE, SPAN = 1 << 18, 64, 1024, 4096
U = np.uint64
PREFIXES = "row long, n int, entries binary"
PAIRS = "a long, b long, overlap long, n_a int, n_b int, last_a long, last_b long"


def prefix_length(n, percent: int):
    """Entries of a row of ``n`` that are multiplied."""
    return n + (-percent * n // 100) + 1


def _classes(counts: np.ndarray) -> np.ndarray:
    return np.minimum(4 * np.log2(counts + 1.0), 255).astype(np.uint8)


def _row(sets: np.ndarray) -> bytes:
    return hashlib.blake2b(sets.tobytes(), digest_size=16).digest()


def _distinct_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list[bytes], np.ndarray]]:
    """Slices of a task's texts: (batch, sets, offsets, prints, places of sets that the task hasn't had yet)."""
    seen: set[bytes] = set()
    for whole in batches:
        for batch in slices(whole, "text", 4 << 20):
            sets, offsets = shingle_sets(*string_buffer(batch.column("text")), width)
            prints = [_row(sets[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            new = []
            for k, (p, doc) in enumerate(zip(prints, batch.column("doc_id").to_pylist(), strict=True)):
                if doc is not None and offsets[k] < offsets[k + 1] and p not in seen:
                    seen.add(p)
                    new.append(k)
            yield batch, sets, offsets, prints, np.array(new, np.int64)


def _read(width: int):
    """Rows (doc_id, n_shingles, row, print), and rows (part, counts) of the counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "row", "print", "part", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        counts = np.zeros(1 << COUNTER_BITS, np.uint32)
        for batch, sets, offsets, prints, new in _distinct_sets(batches, width):
            fresh = np.zeros(len(prints), bool)
            fresh[new] = True
            own = sets[np.repeat(fresh, np.diff(offsets))]
            counts += np.bincount((own >> U(64 - COUNTER_BITS)).astype(np.int64), minlength=len(counts)).astype(np.uint32)
            rows = [int.from_bytes(p[:8], "little", signed=True) for p in prints]
            columns = [batch.column("doc_id"), np.diff(offsets), rows, prints, [None] * len(prints), [None] * len(prints)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) if not isinstance(c, pa.Array) else c for c, k in zip(columns, kinds, strict=True)], names)
        if counts.any():
            parts = [zlib.compress(np.minimum(p, 255).astype(np.uint8).tobytes(), 1) for p in np.split(counts, COUNTER_TASKS)]
            none = [None] * len(parts)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([none] * 4 + [range(len(parts)), parts], kinds, strict=True)], names)
        let_go()

    return run


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, counts) of all tasks -> classes and sums of those parts that come to this task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            own = np.frombuffer(zlib.decompress(counts), np.uint8)
            total[part] = total[part] + own if part in total else own.astype(np.int64)
    columns = [pa.array(list(total), pa.int32()), pa.array([_classes(t).tobytes() for t in total.values()], pa.binary()), pa.array([int(t.sum()) for t in total.values()], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["part", "classes", "total"])


def _prefixes(width: int, percent: int, classes):
    """Each set's first entries in the order of all n-grams: (row, n, entries as sorted 64-bit numbers: class, then hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = np.frombuffer(classes.value, np.uint8)
        for _, sets, offsets, prints, new in _distinct_sets(batches, width):
            order = of[(sets >> U(64 - COUNTER_BITS)).astype(np.int64)].astype(U) << U(56) | sets >> U(8)
            rows, sizes, entries = [], [], []
            for k in new.tolist():
                own = np.sort(order[offsets[k] : offsets[k + 1]])
                rows.append(int.from_bytes(prints[k][:8], "little", signed=True))
                sizes.append(len(own))
                entries.append(own[: prefix_length(len(own), percent)].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(sizes, pa.int32()), pa.array(entries, pa.binary())], ["row", "n", "entries"])
        let_go()

    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Entries, and for each its row, the row's size, the entry's place and the row's last entry."""
    data, at = string_buffer(batch.column("entries"))
    entries, at = np.frombuffer(data.tobytes(), U), at // 8
    lengths = np.diff(at)
    spread = lambda a: np.repeat(a, lengths)
    rows, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "n"))
    return entries, spread(rows), spread(sizes), np.arange(len(entries)) - spread(at[:-1]), spread(entries[at[1:] - 1] >> U(32))


def _columns(blocks: int, sure: int):
    """Prefixes -> the entries of each block of columns, without those of columns that are surely long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["block", "entry", "row", "n", "place", "last"], [U, np.int64, np.uint32, np.uint32, np.uint32]
        for whole in batches:
            for batch in slices(whole, "entries", 2 << 20):
                flat = _flat(batch)
                kept = np.flatnonzero(flat[0] >> U(56) < U(sure))
                with np.errstate(over="ignore"):
                    block = ((flat[0][kept] * U(0x9E3779B97F4A7C15)) >> U(33)).astype(np.int64) % blocks
                kept = kept[np.argsort(block, kind="stable")]
                found, first = np.unique(np.sort(block), return_index=True)
                cut = [[a.tobytes() for a in np.split(f[kept].astype(k), first[1:])] for f, k in zip(flat, kinds, strict=True)] if len(found) else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *[pa.array(c, pa.binary()) for c in cut]], names)
        let_go()

    return run


def _surely_long(sure: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "entries", 2 << 20):
                entries, rows = _flat(batch)[:2]
                of = entries >> U(56) >= U(sure)
                yield pa.RecordBatch.from_arrays([pa.array(entries[of].view(np.int64)), pa.array(rows[of], pa.int64())], ["a", "b"])

    return run


def _need(n, m, percent: int):
    """Overlap that two sets of these sizes have at least if they are linked."""
    return -(-percent * (n + m) // (100 + percent))


def _multiplied(percent: int):
    """A block of columns -> overlaps of the pairs in its short columns; rows (a: column, b: row, null overlap) for its long ones."""

    def run(table: pa.Table) -> pa.Table:
        kinds = {"entry": U, "row": np.int64, "n": np.uint32, "place": np.uint32, "last": np.uint32}
        entry, row, n, place, last = (np.frombuffer(b"".join(table[c].to_pylist()), k) for c, k in kinds.items())
        n, place, last = (a.astype(np.int64) for a in (n, place, last))
        order = np.lexsort((n, entry))
        starts = np.flatnonzero(np.diff(entry[order], prepend=entry[order[:1]] ^ U(1)))
        sizes = np.diff(np.append(starts, len(order)))
        of_size = np.repeat(sizes, sizes)
        long, short = order[of_size > LONG], order[(of_size > 1) & (of_size <= LONG)]
        pairs = []
        entries, step = entry[short], 1
        at = np.arange(len(short) - step)
        while len(at := at[at + step < len(short)]):
            at = at[entries[at] == entries[at + step]]
            x, y = short[at], short[at + step]  # n[x] <= n[y]
            before, beyond = np.minimum(place[x], place[y]) + 1, np.minimum(n[x] - place[x], n[y] - place[y]) - 1
            fit = (100 * n[x] >= percent * n[y]) & (before + beyond >= _need(n[x], n[y], percent)) & (row[x] != row[y])
            pairs.append((x[fit], y[fit]))
            step += 1
        x, y = (np.concatenate(p) for p in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
        x, y = np.where(row[x] < row[y], x, y), np.where(row[x] < row[y], y, x)
        order = np.lexsort((row[y], row[x]))
        x, y = x[order], y[order]
        firsts = np.flatnonzero((np.diff(row[x], prepend=0) != 0) | (np.diff(row[y], prepend=0) != 0) | (np.arange(len(x)) == 0))
        overlap = np.diff(np.append(firsts, len(x)))
        x, y, none = x[firsts], y[firsts], [None] * len(long)
        columns = [row[x], row[y], overlap, n[x], n[y], last[x], last[y]]
        longs = [entry[long].view(np.int64), row[long], none, none, none, none, none]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        names = [f.split()[0] for f in PAIRS.split(", ")]
        return pa.table([pa.concat_arrays([pa.array(c, t), pa.array(more, t)]) for c, more, t in zip(columns, longs, types, strict=True)], names)

    return run


def forest(linked: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of the links between the rows and columns of a Boolean matrix: (first row, rows, columns)."""
    new_row, new_column = np.ones(len(linked), bool), np.ones(linked.shape[1], bool)
    for k in np.flatnonzero(linked.any(1)).tolist():
        if not new_row[k]:
            continue
        new_row[k] = False
        at, rows, columns = np.array([k]), [np.array([k])], []
        while len(at):
            there = np.flatnonzero(linked[at].any(0) & new_column)
            new_column[there] = False
            columns.append(there)
            at = np.flatnonzero(linked[:, there].any(1) & new_row)
            new_row[at] = False
            rows.append(at)
        yield k, np.concatenate(rows), np.concatenate(columns)


def _tile(percent: int):
    """Rows of two blocks (or twice one) of a long column: a spanning forest of the pairs that their entries allow."""

    def run(table: pa.Table) -> pa.Table:
        block, low, high = table["block"].to_numpy(), table["low"][0].as_py(), table["high"][0].as_py()
        x, y = np.flatnonzero(block == low), np.flatnonzero(block == high)
        own = [np.frombuffer(e, U) for e in table["entries"].to_pylist()]
        rows, n, last = table["row"].to_numpy(), table["n"].to_numpy().astype(np.int64), np.array([e[-1] for e in own], U)
        lengths = np.array([len(e) for e in own])
        owner = np.repeat(np.arange(len(own)), lengths)
        _, column, rows_of = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        shared = rows_of[column] > 1
        owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        need = _need(n[x][:, None], n[y][None, :], percent)
        beyond = -(-percent * n // 100) - 1
        # of two rows, all common entries up to the smaller last one are multiplied
        beyond = np.where(last[x][:, None] <= last[y][None, :], beyond[x][:, None], beyond[y][None, :])
        able = (100 * np.minimum(n[x][:, None], n[y][None, :]) >= percent * np.maximum(n[x][:, None], n[y][None, :])) & (rows[x][:, None] != rows[y][None, :])
        overlap, left = np.zeros(able.shape, np.float32), np.bincount(owner, minlength=len(own))
        in_x, in_y = np.full(len(own), -1), np.full(len(own), -1)
        in_x[x], in_y[y] = np.arange(len(x)), np.arange(len(y))
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, SPAN):
            if not able.any():
                break
            a, b = np.searchsorted(column, (at, at + SPAN))
            p, q = (np.zeros((len(side), SPAN), np.float32) for side in (x, y))
            for matrix, place in ((p, in_x), (q, in_y)):
                here = np.flatnonzero(place[owner[a:b]] >= 0)
                np.add.at(matrix, (place[owner[a:b][here]], column[a:b][here] - at), 1)
            overlap += p @ q.T  # counts below 2 ** 24: exact
            left = left - np.bincount(owner[a:b], minlength=len(own))
            able &= overlap + np.minimum(left[x][:, None], left[y][None, :]) + beyond >= need
        able &= overlap + beyond >= need
        pairs = [(int(rows[x[k]]), int(m)) for k, ra, rb in forest(able) for m in np.concatenate((rows[x[ra]], rows[y[rb]])) if m != rows[x[k]]]
        a, b = zip(*set(pairs), strict=True) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _tiles(long: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Long columns (column, row) -> links (a, b) that the rows' entries allow: all rows of a column, a tile in a task."""
    sizes = long.groupBy("column").agg(F.ceil(F.count("*") / TILE).cast("long").alias("blocks")).withColumnRenamed("column", "of")
    dealt = long.join(sizes, F.col("column") == F.col("of")).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "row"), F.col("blocks")))
    dealt = dealt.select("column", "row", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("column", F.col("row").alias("r"), "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    cells = dealt.join(prefixes, F.col("r") == F.col("row")).select("column", "low", "high", "block", "row", "n", "entries")
    return cells.groupBy("column", "low", "high").applyInArrow(_tile(percent), "a long, b long")


def candidate_links(prefixes: DataFrame, percent: int, sure: int) -> DataFrame:
    """Links (a, b) between rows of ``prefixes`` (materialized) that the product doesn't rule out, long columns' as forests."""
    scratch = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(materialize(df, name))
        return scratch[-1]

    entries = prefixes.agg(F.sum(F.octet_length("entries") / 8)).first()[0] or 0
    blocks = max(LEAST_BLOCKS, int(entries) // BLOCK)
    columns = prefixes.mapInArrow(_columns(blocks, sure), "block int, entry binary, row binary, n binary, place binary, last binary")
    product = kept(columns.groupBy("block").applyInArrow(_multiplied(percent), PAIRS), "product")
    long = product.where("overlap is null").select("a", "b")
    if sure < 256:
        long = long.union(prefixes.mapInArrow(_surely_long(sure), "a long, b long"))
    long = kept(long.distinct().toDF("column", "row"), "long")
    in_long = kept(long.groupBy("row").agg(F.count("*").alias("more")), "in-long")

    short = product.where("overlap is not null").groupBy("a", "b").agg(F.sum("overlap").alias("overlap"), *[F.first(c).alias(c) for c in ("n_a", "n_b", "last_a", "last_b")])
    more = lambda c: in_long.select(F.col("row").alias(f"row_{c}"), F.col("more").alias(f"more_{c}"))
    short = short.join(more("a"), F.col("a") == F.col("row_a"), "left").join(more("b"), F.col("b") == F.col("row_b"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    beyond = lambda c: F.ceil(F.lit(percent) * F.col(c) / 100) - 1
    first_ends: Column = F.when(F.col("last_a") < F.col("last_b"), beyond("n_a")).when(F.col("last_a") > F.col("last_b"), beyond("n_b"))
    reach = F.col("overlap") + F.least(zero("more_a"), zero("more_b")) + F.coalesce(first_ends, F.greatest(beyond("n_a"), beyond("n_b")))
    links = kept(short.where(reach * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "short-links")

    # columns of the same rows are multiplied once
    sums = [F.bit_xor(F.xxhash64(F.lit(salt), "row")).alias(salt) for salt in ("s", "t")]
    once = long.groupBy("column").agg(F.count("*").alias("rows"), *sums).where("rows > 1").groupBy("rows", "s", "t").agg(F.min("column").alias("of"))
    long = kept(long.join(once.select("of"), F.col("column") == F.col("of"), "left_semi"), "long-once")
    if not long.isEmpty():
        rank = F.row_number().over(Window.partitionBy("row").orderBy("column"))
        links = links.union(kept(_tiles(long.withColumn("rank", rank).where("rank <= 2").drop("rank"), prefixes, percent), "long-links"))
        groups = components(links)
        scratch.append(groups)
        of = long.join(groups, F.col("row") == F.col("node"), "left").select("column", "row", F.coalesce("component", "row").alias("component"))
        mixed = of.groupBy("column").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select(F.col("column").alias("of"))
        links = links.union(_tiles(of.join(mixed, F.col("column") == F.col("of")).select("column", "row"), prefixes, percent))
    out = materialize(links.distinct(), "candidates")
    discard(*scratch)
    return out


def ngram_join(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Join rows whose sets of ``width``-word shingles have 100 * intersection >= percent * union; the classes of that relation.

    Returns one row for each row of ``docs``: doc_id, n_shingles (size of its set), component_id (the smallest doc_id that
    can be reached by links, itself included).

    Null and empty texts, and texts of white space, have no shingles and are linked with nothing. A text of fewer words than
    ``width`` has one shingle, all its words. Equal sets are linked; at exactly ``percent`` two sets are linked. Rows with a null
    doc_id have a null component_id and link nothing. Rows that repeat a doc_id share its component, whatever their texts.
    No rows give no rows; other columns aren't read, whatever their names.

    No link is lost. Shingles are 64-bit hashes, so sizes and links hold up to a collision of these. A worker holds a slice of a
    batch (4 MB of text, or one longer text) and some bytes for each of its bytes, the counters, BLOCK entries and a row's,
    or two times TILE rows by their first entries. The counters' classes, 4 MB at any size, are broadcast.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), whole_text(docs, text_column).alias("text"))
    read = materialize(rows.mapInArrow(_read(width), "doc_id long, n_shingles long, row long, print binary, part int, counts binary"), "rows")
    table = read.where("part is null").select("doc_id", "n_shingles", "row", "print")
    counters = read.where("part is not null").select("part", "counts").repartition(COUNTER_TASKS, "part").mapInArrow(_added_up, "part int, classes binary, total long")
    parts = {r.part: r for r in counters.collect()}  # a fixed size
    none = bytes((1 << COUNTER_BITS) // COUNTER_TASKS)
    classes = docs.sparkSession.sparkContext.broadcast(b"".join(parts[k].classes if k in parts else none for k in range(COUNTER_TASKS)))
    mean = sum(r.total for r in parts.values()) / (1 << COUNTER_BITS)
    sure = int(_classes(np.array([2 * mean + SURELY_LONG]))[0]) + 1

    found = rows.mapInArrow(_prefixes(width, percent, classes), PREFIXES)
    prefixes = materialize(found.dropDuplicates(), "prefixes")
    linkable = table.where("n_shingles > 0 and doc_id is not null")
    sets = materialize(linkable.groupBy("print").agg(F.min("doc_id").alias("rep"), F.first("row").alias("row")), "sets")
    links = candidate_links(prefixes, percent, sure)
    named = lambda c: sets.select(F.col("row").alias(f"row_{c}"), F.col("rep").alias(f"rep_{c}"))
    links_of = links.join(named("a"), F.col("a") == F.col("row_a")).join(named("b"), F.col("b") == F.col("row_b")).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    # different sets whose rows go by one number: candidates like any other
    same = sets.groupBy("row").agg(F.min("rep").alias("a"), F.count("*").alias("sets")).where("sets > 1").withColumnRenamed("row", "of")
    links_of = links_of.union(same.join(sets, F.col("of") == F.col("row")).where("a <> rep").select("a", F.col("rep").alias("b")))
    members = components(links_of)
    groups = exact_groups(rows.withColumnRenamed("doc_id", "rep"), members, percent, width)
    several = linkable.groupBy("doc_id").agg(F.min("print").alias("least"), F.max("print").alias("most")).where("least < most")
    if not several.isEmpty():  # texts of one id: linked by it, whatever they are
        of_id = several.select(F.col("doc_id").alias("id")).join(linkable, F.col("id") == F.col("doc_id")).select("id", F.col("print").alias("of"))
        of_id = of_id.join(sets, F.col("of") == F.col("print")).select(F.col("id").alias("a"), F.col("rep").alias("b"))
        joined = components(of_id.union(groups.select(F.col("root").alias("a"), F.col("node").alias("b"))))
        discard(groups)
        groups = joined.withColumnRenamed("component", "root")
        groups._written_at = joined._written_at
    roots = sets.select(F.col("print").alias("of"), "rep").join(groups, F.col("rep") == F.col("node"), "left")
    roots = materialize(roots.select("of", F.coalesce("root", "rep").alias("root")), "roots")
    discard(links, members, groups, sets, prefixes)
    # sets of no shingles and rows without an id look up a key of their own, so that they don't meet in one task
    alone = F.concat(F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")
    key = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("print")).otherwise(alone)
    out = table.select("doc_id", "n_shingles", key.alias("key")).join(roots, F.col("key") == F.col("of"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
