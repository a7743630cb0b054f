"""MinHash near-dedup by a chosen-path set similarity join.

Each distinct shingle set has TOKENS minwise tokens. In each of several independent trees the
sets walk from node to node: a node picks one or two of the token places at random, and its
sets move on to the children that their tokens at those places name, so that similar sets keep
meeting. A node of up to NODE sets is finished in one task, which goes on branching there until
nodes are small, and compares all sets of a small node by their tokens. A larger node branches as
a table. At each branching, there or in a task, the sets of a node are compared with one of them,
its pivot: sets that are nearly the pivot's copies need go no further, as whatever is close to
them is close to the pivot too; and a node whose sets are all of one component by the links found
so far has none left to find. Nothing is dropped: what is still large after LEVELS levels, or is
little enough, is compared whole, in blocks.

That gives candidate links, of which each node keeps a spanning forest. Their components are then
verified on the full sets, recomputed from the texts: one task holds a component, or one of
several blocks that a large component is dealt into, each with the component's pivots. Where the
blocks of a component don't come out as one group, the sets outside its largest group are compared
with all of its blocks. Only exact links, 100 * intersection >= 80 * union, make the result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import components, discard, let_go, materialize, slices, string_buffer, whole_text

#: After LEVELS levels of large nodes, or DEPTH in a task, whatever is left is compared, however much it is.
TOKENS, TREES, LEVELS, DEPTH = 64, 12, 24, 24
#: Largest node that is finished in one task (256 bytes a set), and largest that is compared exhaustively.
NODE, SMALL = 16_384, 48
#: Larger nodes are compared exhaustively once that takes so many comparisons for each set of the input; sets in a block.
COMPARISONS, CELL = 1024, 1024
#: Estimates from TOKENS tokens (standard error 0.05 at 0.8): candidates, and sets that a pivot stands for.
CANDIDATE, STANDS_FOR = 0.6, 0.9
#: Sets and bytes of text that one verification task holds, and pivots in each block of a large component.
BLOCK_SETS, BLOCK_BYTES, PIVOTS = 256, 8 << 20, 8
#: Words over so many bytes are hashed one by one.
LONG_WORD = 256
U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _odd_numbers(n: int, seed: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


BASE = 0xD1342543DE82EF95
FACTORS, ADDENDS = _odd_numbers(TOKENS, 11), _odd_numbers(TOKENS, 12)
#: The first 0 to 8 bytes of a little-endian number.
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at [start, end) of the bytes, eight bytes of all words at a time."""
    sizes = end - start
    eight = np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    out = _mixed(sizes.astype(U))
    live, k = np.flatnonzero(sizes <= LONG_WORD), 0
    with np.errstate(over="ignore"):
        while len(live):
            left = sizes[live] - k
            out[live] = _mixed(out[live] * U(BASE) + (eight[start[live] + k] & FIRST_BYTES[np.minimum(left, 8)]))
            live, k = live[left > 8], k + 8
    for n in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[n] = int.from_bytes(hashlib.blake2b(data[start[n] : end[n]].tobytes(), digest_size=8).digest(), "little")
    return out


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, one after the other, and the offsets of the texts in them.

    Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return, with A-Z
    lower-cased. A text with fewer words than ``width`` has one shingle, all its words; one without words has none.
    """
    texts = len(at) - 1
    white = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~white
    begins[1:] &= white[:-1]
    firsts = at[:-1][at[:-1] < len(data)]
    begins[firsts] = ~white[firsts]
    ends = ~white
    ends[:-1] &= white[1:]
    lasts = at[1:][at[1:] > 0] - 1
    ends[lasts] = ~white[lasts]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    words = word_hashes(low, start, end)
    with np.errstate(over="ignore"):
        per_text = np.searchsorted(start, at)  # words before each text
        out, offsets = [], np.zeros(texts + 1, np.int64)
        rolled = words[: max(0, len(words) - width + 1)].copy()
        for k in range(1, width):
            rolled = _mixed(rolled * U(BASE) + words[k : len(words) - width + 1 + k])
        for n in range(texts):
            a, b = per_text[n], per_text[n + 1]
            if b - a >= width:
                own = np.sort(rolled[a : b - width + 1])
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif b > a:
                one = U(b - a)
                for w in words[a:b]:
                    one = _mixed(np.array([one * U(BASE) + w], U))[0]
                own = np.array([one], U)
            else:
                own = np.zeros(0, U)
            out.append(own)
            offsets[n + 1] = offsets[n] + len(own)
    return (np.concatenate(out) if out else np.zeros(0, U)), offsets


def minwise(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """TOKENS minwise tokens of each set; zeros for an empty one."""
    out = np.zeros((len(offsets) - 1, TOKENS), np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        starts = offsets[:-1][full]
        with np.errstate(over="ignore"):
            for k in range(TOKENS):
                out[full, k] = np.minimum.reduceat(((sets * FACTORS[k] + ADDENDS[k]) >> U(32)).astype(np.uint32), starts)
    return out


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                sets, offsets = shingle_sets(*string_buffer(batch.column("text")), width)
                tokens, sizes = minwise(sets, offsets), np.diff(offsets)
                prints = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array([t.tobytes() for t in tokens], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "print", "tokens"])
        let_go()

    return run


def _roots(n: int, pairs) -> list[int]:
    """Smallest member of each one's group under the pairs."""
    parent = list(range(n))
    for a, b in pairs:
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        parent[max(a, b)] = min(a, b)
    for k in range(n):
        parent[k] = parent[parent[k]]
    return parent


def _branch(node: int, rows: np.ndarray, reps: np.ndarray, tokens: np.ndarray) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Go on branching a node of more than SMALL sets: (candidate links found on the way, small nodes that are left)."""
    links, small, group = [], [], np.arange(len(rows))
    stack = [(U(node & (1 << 64) - 1), np.arange(len(rows)), 0)]

    def unite(pivot: int, near: np.ndarray) -> None:
        fresh = near[group[near] != group[pivot]]
        if len(fresh):
            _, first = np.unique(group[fresh], return_index=True)  # a spanning forest will do
            links.extend((int(reps[rows[pivot]]), int(reps[rows[m]])) for m in fresh[first].tolist())
            group[np.isin(group, group[fresh])] = group[pivot]

    while stack:
        path, own, depth = stack.pop()
        if len(own) <= SMALL:
            if len(own) > 1:
                small.append(rows[own])
            continue
        pivot = own[np.argmin(_mixed(reps[rows[own]].astype(U) ^ path))]
        alike = np.count_nonzero(tokens[rows[own]] == tokens[rows[pivot]], axis=1)
        unite(pivot, own[alike >= CANDIDATE * TOKENS])
        own = own[(alike < STANDS_FOR * TOKENS) | (own == pivot)]
        if (group[own] == group[own[0]]).all():
            continue
        if depth == DEPTH:
            for k in range(0, len(own), CELL):
                for m in range(k, len(own), CELL):
                    x, y = own[k : k + CELL], own[m : m + CELL]
                    for pivot, near in _forest(tokens[rows[x]], tokens[rows[y]], k == m):
                        unite(x[pivot], np.concatenate((x[near[0]], y[near[1]])))
            continue
        h = _mixed(path ^ np.array([1, 2, 3], U)).tolist()
        first = h[0] % TOKENS
        for place in (first, (first + 1 + h[1] % (TOKENS - 1)) % TOKENS)[: 2 if h[2] % 4 == 0 else 1]:
            named = tokens[rows[own], place]
            order = np.argsort(named, kind="stable")
            cuts = np.flatnonzero(np.diff(named[order])) + 1
            for child in np.split(order, cuts):
                if len(child) > 1:
                    name = U(int(named[child[0]]) << 8 | place)
                    stack.append((_mixed(np.array([path ^ _mixed(np.array([name], U))[0]], U))[0], own[child], depth + 1))
    return links, small


def _compare_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, rep, tokens) sorted by node, up to NODE of one: a spanning forest of each node's candidate links."""

    def links(ids: np.ndarray, reps: np.ndarray, tokens: np.ndarray) -> list[tuple[int, int]]:
        starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        sizes, out, by_size = np.diff(np.append(starts, len(ids))), [], defaultdict(list)
        for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
            found, small = _branch(int(ids[start]), np.arange(start, start + size), reps, tokens)
            out += found
            for rows in small:
                by_size[len(rows)].append(rows)
        for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]).tolist():
            by_size[size].append(starts[sizes == size][:, None] + np.arange(size))
        for size, parts in by_size.items():
            own, step = np.vstack(parts), max(1, (4 << 20) // (size * size * TOKENS))
            for k in range(0, len(own), step):
                rows = own[k : k + step]
                t = tokens[rows]
                alike = np.count_nonzero(t[:, :, None, :] == t[:, None, :, :], axis=3) >= CANDIDATE * TOKENS
                alike &= np.triu(np.ones((size, size), bool), 1)
                for g in np.flatnonzero(alike.any((1, 2))).tolist():
                    own_reps = reps[rows[g]].tolist()
                    place = sorted(range(size), key=own_reps.__getitem__)  # groups point at their smallest set
                    rank = np.argsort(place)
                    parent = _roots(size, rank[np.argwhere(alike[g])].tolist())
                    out += [(own_reps[place[p]], own_reps[place[m]]) for m, p in enumerate(parent) if p != m]
        return out

    def result(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*set(pairs), strict=True) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = (
            batch.column("node").to_numpy(zero_copy_only=False), batch.column("rep").to_numpy(zero_copy_only=False),
            np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(-1, TOKENS),
        )
        ids, reps, tokens = new if held is None else (np.concatenate(x) for x in zip(held, new, strict=True))
        last = int(np.searchsorted(ids, ids[-1]))  # the last node may go on in the next batch; nodes are bounded
        held = (ids[last:], reps[last:], tokens[last:])
        yield result(links(ids[:last], reps[:last], tokens[:last]))
    if held is not None:
        yield result(links(*held))
    let_go()


def _forest(a: np.ndarray, b: np.ndarray, twice: bool) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """Groups of candidates between two blocks of tokens (``twice``: one block, given twice): (a place in a, places in a and in b)."""
    same, across = np.zeros((len(a), len(b)), np.uint8), np.ascontiguousarray(b.T)
    for k in range(TOKENS):
        same += a[:, k][:, None] == across[k]
    alike = same >= CANDIDATE * TOKENS
    if twice:
        np.fill_diagonal(alike, False)
    new_a, new_b = np.ones(len(a), bool), np.ones(len(b), bool)
    for k in np.flatnonzero(alike.any(1)).tolist():
        if not new_a[k]:
            continue
        new_a[k] = False
        at, in_a, in_b = np.array([k]), [], []
        while len(at):  # from side to side, until the group brings no more
            there = np.flatnonzero(alike[at].any(0) & new_b)
            new_b[there] = False
            in_b.append(there)
            at = np.flatnonzero(alike[:, there].any(1) & new_a)
            new_a[at] = False
            in_a.append(at)
        yield k, (np.concatenate(in_a), np.concatenate(in_b))


def _compare_cell(table: pa.Table) -> pa.Table:
    """Rows of two blocks (or twice one) of a node: a spanning forest of the candidate links between the blocks."""
    block, reps = table["block"].to_numpy(), table["rep"].to_numpy()
    tokens = np.frombuffer(b"".join(table["tokens"].to_pylist()), np.uint32).reshape(-1, TOKENS)
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    x, y = np.flatnonzero(block == low), np.flatnonzero(block == high)
    pairs = []
    for k, (in_x, in_y) in _forest(tokens[x], tokens[y], low == high):
        pairs += [(int(reps[x[k]]), int(m)) for m in np.concatenate((reps[x[in_x]], reps[y[in_y]])) if m != reps[x[k]]]
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _compare_large(nodes: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows (path, rep, left) of nodes of ``left`` sets -> candidate links (a, b): all pairs of a node, two blocks of it in a task."""
    dealt = nodes.withColumn("blocks", F.ceil(F.col("left") / CELL).cast("long"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "rep"), F.col("blocks")))
    dealt = dealt.select("path", "rep", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("path", "rep", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    cells = dealt.join(sketches, "rep").select("path", "low", "high", "block", "rep", "tokens")
    return cells.groupBy("path", "low", "high").applyInArrow(_compare_cell, "a long, b long")


def _likeness(rows: DataFrame) -> DataFrame:
    """Add ``alike``, the share of places where ``tokens`` and ``pivot_tokens`` agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(-1, TOKENS) for c in ("tokens", "pivot_tokens"))
            alike = pa.array((x == y).mean(axis=1) if len(x) else [], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("rep"), b.column("pivot"), alike], ["path", "rep", "pivot", "alike"])

    return rows.select("path", "rep", "pivot", "tokens", "pivot_tokens").mapInArrow(run, "path long, rep long, pivot long, alike double")


def _children(rows: DataFrame) -> DataFrame:
    """Rows (path, rep, tokens) -> (path, rep) of the children: one place chosen by each node, two by every fourth."""
    h = lambda salt: F.xxhash64(F.lit(salt), "path")
    first = F.pmod(h("first"), F.lit(TOKENS)).cast("int")
    second = F.when(F.pmod(h("both"), F.lit(4)) == 0, F.pmod(first + 1 + F.pmod(h("second"), F.lit(TOKENS - 1)).cast("int"), F.lit(TOKENS)))
    token = lambda j: F.substring("tokens", j * 4 + 1, F.lit(4))
    places = F.array_compact(F.array(first, second))
    rows = rows.select("path", "rep", "tokens", F.explode(places).alias("place"))
    return rows.select(F.xxhash64("path", "place", token(F.col("place"))).alias("path"), "rep")


def _united(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def candidate_links(sketches: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) among the sets of ``sketches`` (rep, tokens; materialized): TREES independent trees."""
    roots = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(F.lit("tree"), t))
    walking = sketches.select(F.explode(roots).alias("path"), "rep", "tokens")
    nodes, links, scratch = [], [], []

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(materialize(df, name))
        return scratch[-1]

    most = COMPARISONS * sketches.count()
    for level in range(LEVELS):
        at = _children(walking)
        # which sets a node holds, as two 64-bit sums: nodes of the same sets are finished once
        sums = [F.bit_xor(F.xxhash64(F.lit(salt), "rep")).alias(salt) for salt in ("s", "t")]
        sizes = at.groupBy("path").agg(F.count("*").alias("n"), F.min_by("rep", F.xxhash64("path", "rep")).alias("pivot"), *sums).where("n > 1")
        sizes = kept(sizes, "sizes")
        once = sizes.where(F.col("n") <= NODE).groupBy("n", "s", "t").agg(F.min("path").alias("path")).select("path")
        nodes.append(at.join(once, "path").select(F.col("path").alias("node"), "rep"))
        large = sizes.where(F.col("n") > NODE).select("path", "pivot")
        if large.isEmpty():
            break
        pivots = sketches.select(F.col("rep").alias("pivot"), F.col("tokens").alias("pivot_tokens"))
        met = at.join(large.join(pivots, "pivot"), "path").join(sketches, "rep")
        judged = kept(_likeness(met), "judged")
        links.append(judged.where((F.col("alike") >= CANDIDATE) & (F.col("rep") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("rep").alias("b")))
        # a node whose sets are of one component by the links so far has no link left to find
        groups = components(_united(links))
        goes_on = (F.col("alike") < STANDS_FOR) | (F.col("rep") == F.col("pivot"))
        of = judged.where(goes_on).join(groups, F.col("rep") == F.col("node"), "left").select("path", "rep", F.coalesce("component", "rep").alias("component"))
        mixed = of.groupBy("path").agg(F.count("*").alias("left"), F.min("component").alias("least"), F.max("component").alias("most"))
        on = kept(of.select("path", "rep").join(mixed.where("least < most").select("path", "left"), "path"), "left")
        discard(groups)
        asked = on.agg(F.sum((F.col("left") - 1) / 2)).first()[0] or 0
        if asked <= most or level == LEVELS - 1:
            # nothing large is dropped: the rest is compared as it is
            links.append(_compare_large(on, sketches))
            break
        walking = on.select("path", "rep").join(sketches, "rep").select("path", "rep", "tokens")
    held = _united(nodes).join(sketches, "rep").select("node", "rep", "tokens")
    found = held.repartition("node").sortWithinPartitions("node").mapInArrow(_compare_nodes, "a long, b long")
    out = materialize(_united([found, *links]).distinct(), "candidates")
    discard(*scratch)
    return out


def _exact_groups(texts: list[bytes], percent: int, width: int, against: int | None = None) -> list[tuple[int, int]]:
    """Exact links as pairs of places: all pairs' intersections by products of incidence matrices, in blocks of shingles.

    With ``against``, only pairs of one of the first ``against`` texts with one of the others.
    """
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    sets, offsets = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), at, width)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(texts)), sizes)
    _, column, df = np.unique(sets, return_inverse=True, return_counts=True)
    shared = df[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(texts), len(texts)), np.float32)
    span = 8192
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, span):
        a, b = np.searchsorted(column, (low, low + span))
        block = np.zeros((len(texts), min(span, int(column[-1]) + 1 - low)), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        both += block @ block.T  # counts below 2 ** 24: exact
    both = both.astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    linked &= (sizes[:, None] > 0) & np.triu(np.ones_like(linked), 1)
    if against is not None:
        linked[:against, :against] = False
        linked[against:, against:] = False
    return np.argwhere(linked).tolist()


def _verify(percent: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["rep"].to_pylist(), table["text"].to_pylist(), strict=True))
        parent = _roots(len(rows), _exact_groups([t.encode() for _, t in rows], percent, width))
        return pa.table({"rep": pa.array([r for r, _ in rows], pa.int64()), "root": pa.array([rows[p][0] for p in parent], pa.int64())})

    return run


def _query(percent: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["asks"].to_pylist(), table["rep"].to_pylist(), table["text"].to_pylist(), strict=True), key=lambda r: (not r[0], r[1]))
        asks = sum(r[0] for r in rows)
        pairs = _exact_groups([t.encode() for _, _, t in rows], percent, width, asks)
        return pa.table({"rep": pa.array([rows[a][1] for a, _ in pairs], pa.int64()), "root": pa.array([rows[b][1] for _, b in pairs], pa.int64())})

    return run


def exact_groups(texts: DataFrame, members: DataFrame, percent: int, width: int) -> DataFrame:
    """Groups by exact links inside the candidate components ``members`` (node, component): rows (node, root), materialized.

    The root is the smallest of its group; nodes that are their own root may be missing. A component that one task
    verifies comes out as whole groups; only those of several blocks have to be put together.
    """
    scratch = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(materialize(df, name))
        return scratch[-1]

    def joined(found: DataFrame) -> DataFrame:
        scratch.append(components(found.select(F.col("root").alias("a"), F.col("rep").alias("b"))))
        return scratch[-1].withColumnRenamed("component", "root")

    def done(groups: DataFrame) -> DataFrame:
        out = materialize(groups, "groups")
        discard(*scratch)
        return out

    # members grow with the corpus: never broadcast, at any size
    held = kept(texts.join(members.hint("merge"), texts["rep"] == members["node"]).select("rep", "text", "component"), "verified-texts")
    repeated = not held.groupBy("rep").count().where("count > 1").isEmpty()
    if repeated:  # rows that repeat their id: each text of it once
        held = kept(held.groupBy("rep", F.sha2(F.col("text").cast("binary"), 256).alias("of")).agg(F.first("text").alias("text"), F.first("component").alias("component")).drop("of"), "once")
    sizes = held.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_SETS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("long")
    sizes = kept(sizes.select("component", blocks.alias("blocks")), "components")
    dealt = held.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("rep", "text"), F.col("blocks")))
    whole = dealt.where("blocks = 1").select("rep", "text", "component", "block").groupBy("component", "block").applyInArrow(_verify(percent, width), "rep long, root long")
    whole = kept(whole.where("rep <> root"), "whole")
    large, groups = sizes.where("blocks > 1"), whole.select(F.col("rep").alias("node"), "root")
    if large.isEmpty():
        return done(joined(whole) if repeated else groups)
    dealt = dealt.where("blocks > 1")
    # every block of a large component gets its pivots: the sets of least hash, a fixed number
    many = held.join(large, "component")
    # the least of each of 64 salts: what any task collects is bounded
    few = many.select("component", "blocks", "rep", F.pmod(F.xxhash64("rep"), F.lit(64)).alias("salt"))
    few = few.groupBy("component", "blocks", "salt").agg(F.min(F.struct(F.xxhash64("rep").alias("h"), "rep")).alias("head"))
    few = few.groupBy("component", "blocks").agg(F.slice(F.array_sort(F.collect_list("head")), 1, PIVOTS).alias("heads"))
    pivots = few.select("component", "blocks", F.explode("heads.rep").alias("pivot")).withColumnRenamed("component", "c")
    pivots = pivots.join(held, F.col("pivot") == F.col("rep")).select("rep", "text", "component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    own = dealt.join(few.select("component", "heads"), "component")
    own = own.where(~F.coalesce(F.array_contains("heads.rep", F.col("rep")), F.lit(False))).select("rep", "text", "component", "block")
    found = kept(own.union(pivots).groupBy("component", "block").applyInArrow(_verify(percent, width), "rep long, root long"), "found")
    # groups over the blocks; whatever is outside the largest group of its component is compared with all blocks
    roots = joined(found)
    grouped = many.select("rep", "component", "blocks").distinct().join(roots, F.col("rep") == F.col("node"), "left")
    grouped = kept(grouped.select("rep", F.col("component").alias("c"), "blocks", F.coalesce("root", "rep").alias("root")), "grouped")
    largest = grouped.groupBy("c", "root").agg(F.count("*").alias("n")).groupBy("c").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    outside = kept(grouped.join(largest, "c").where("root <> main").select("rep", F.col("c"), "blocks"), "outside")
    if outside.isEmpty():
        return done(joined(found.union(whole)) if repeated else groups.union(roots))
    per = outside.groupBy("c").agg(F.count("*").alias("asking")).withColumnRenamed("c", "ac")
    asks = outside.join(per, F.col("c") == F.col("ac")).withColumn("ask", F.pmod(F.xxhash64(F.lit("ask"), "rep"), F.ceil(F.col("asking") / BLOCK_SETS)))
    asking = asks.withColumnRenamed("rep", "asking_rep").join(held, F.col("asking_rep") == F.col("rep"))
    asking = asking.select(F.lit(True).alias("asks"), "rep", "text", "component", "ask", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    batches = per.select("ac", F.explode(F.sequence(F.lit(0), F.ceil(F.col("asking") / BLOCK_SETS) - 1)).alias("ask"))
    answering = dealt.join(batches, F.col("component") == F.col("ac")).select(F.lit(False).alias("asks"), "rep", "text", "component", "ask", "block")
    more = asking.union(answering).groupBy("component", "block", "ask").applyInArrow(_query(percent, width), "rep long, root long")
    found = found.union(more)
    return done(joined(found.union(whole)) if repeated else groups.union(joined(found)))


def near_dedup(docs: DataFrame, percent: int = 80, width: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Group rows whose sets of ``width``-word shingles are linked, directly or over others.

    Returns one row for each row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable),
    kept (doc_id = component_id).

    Args:
        percent: two sets are linked if 100 * intersection >= percent * union.

    Null and empty texts, and texts of white space, have no shingles and are linked with nothing. Equal sets are
    linked. Ties are links: at exactly ``percent`` two sets are linked. Rows with a null doc_id have a null
    component_id and are kept; they link nothing. Rows that repeat a doc_id share its component, whatever their
    texts. No rows give no rows; other columns aren't read, whatever their names.

    Candidates come from TREES random trees: a pair at exactly the threshold is missed with a probability of about
    0.1 %; what is found is exact. A worker holds a slice of a batch (4 MB of text, or one longer text) and some
    bytes for each of its bytes, a node of NODE sets by their tokens, or BLOCK_BYTES of texts that it verifies.
    Tables that the result doesn't read are deleted; sketches and roots stay, as the result is read later.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), whole_text(docs, text_column).alias("text"))
    table = materialize(rows.mapInArrow(_sketches(width), "doc_id long, n_shingles long, print binary, tokens binary"), "sketches")
    linkable = table.where("n_shingles > 0 and doc_id is not null")
    sets = materialize(linkable.groupBy("print").agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens")), "sets")
    candidates = candidate_links(sets.select("rep", "tokens"))
    members = components(candidates)
    groups = exact_groups(rows.withColumnRenamed("doc_id", "rep"), members, percent, width)
    roots = sets.select(F.col("print").alias("of"), "rep").join(groups, F.col("rep") == F.col("node"), "left")
    roots = materialize(roots.select("of", F.coalesce("root", "rep").alias("root")), "roots")
    discard(candidates, members, groups, sets)
    # sets of no shingles and rows without an id look up a key of their own, so that they don't meet in one task
    alone = F.concat(F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")
    key = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("print")).otherwise(alone)
    out = table.select("doc_id", "n_shingles", key.alias("key")).join(roots, F.col("key") == F.col("of"), "left")
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
