"""Source divergence audit: how far each source's vocabulary lies from the others of its language.

Texts are read once: each task adds up, by language, source and term, how many of its documents have
the term and how often, and Spark adds up the tasks. Terms of enough documents are kept. A language's
kept terms are dealt by hash into chunks of a bounded number of rows. In a chunk the kept terms are
sorted by their UTF-8 bytes, so that a term's id is its place (searchsorted), and the order of ids is
the order of the terms. Counts become dense vectors of a group by id (bincount), a bounded number of
cells at a time; smoothed shares, divergences between all sources and the terms that stand out come
from these. Sums over chunks are exact, and of terms a chunk passes on no more than can be reported.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import let_go, materialize

#: Documents that a kept term is in, at least; parts of a whole that a share counts; terms that are reported of a group.
LEAST_DOCS, WHOLE, TOP = 3, 1_000_000_000, 200
#: Terms (with their groups) that a task adds up before it passes them on; rows of a chunk; cells of dense vectors at once.
TERMS_HELD, CHUNK_ROWS, CELLS = 500_000, 100_000, 1 << 21
#: Languages whose number of chunks may be broadcast; more are joined by a shuffle.
FEW_LANGS = 100_000
#: Every byte that isn't part of a term becomes a space, and A-Z small letters; bytes from 0x80 are of characters beyond ASCII.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) -> (lang, source, term, docs, times), added up; a null term for the group itself."""
    times: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in times.items():
            terms, n = [None, *own], len(own) + 1
            in_docs = docs[lang, source]
            columns = [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array([None if t is None else t.decode() for t in terms], pa.string())]
            columns += [pa.array([0, *map(in_docs.__getitem__, own)], pa.int64()), pa.array([0, *own.values()], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "docs", "times"])
        times.clear()
        docs.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            found, all_times, in_docs = text.translate(TERM_BYTES).split(b" "), times[lang, source], docs[lang, source]
            before = len(all_times)
            own = Counter(found)
            own.pop(b"", None)
            all_times.update(own)
            in_docs.update(own.keys())
            held += len(all_times) - before
            if held > TERMS_HELD:
                yield from passed_on()
                held = 0
    yield from passed_on()
    let_go()


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(WHOLE * (counts + 1) / total), exactly: the quotient is worked out three decimal digits at a time."""
    out, rest = np.divmod(counts + 1, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def _chunk(table: pa.Table, groups: pa.Table) -> pa.Table:
    """Kept terms of a chunk (source, term, times), and all groups of its language (source, n_times, n_terms, lang_times)."""
    groups = groups.sort_by("source")  # any fixed order
    lang, sources = groups["lang"][0].as_py(), groups["source"].to_pylist()
    n_terms, lang_times = groups["n_terms"][0].as_py(), groups["lang_times"][0].as_py()
    totals = groups["n_times"].to_numpy() + n_terms
    numbers = {s: k for k, s in enumerate(sources)}
    terms = [t.encode() for t in table["term"].to_pylist()]
    kept = np.array(sorted(set(terms)), object)
    held = np.empty(len(terms), object)
    held[:] = terms
    ids, own, times = np.searchsorted(kept, held), np.array([numbers[s] for s in table["source"].to_pylist()], np.int64), table["times"].to_numpy()
    apart = np.zeros((len(sources), len(sources)), np.int64)
    ahead: list[list[tuple[int, int]]] = [[] for _ in sources]
    step = max(1, CELLS // len(sources))
    order = np.argsort(ids, kind="stable")
    for low in range(0, len(kept), step):
        width = min(step, len(kept) - low)
        rows = order[slice(*np.searchsorted(ids, (low, low + width), sorter=order))]
        cells = own[rows] * width + ids[rows] - low
        # a cell is met once, and counts are below 2 ** 53, which doubles hold exactly
        dense = np.bincount(cells, times[rows], len(sources) * width).astype(np.int64).reshape(len(sources), width)
        p, q = shares(dense, totals[:, None]), shares(dense.sum(0), np.int64(lang_times + n_terms))
        for k in range(len(sources)):
            apart[:, k] += ((p - p[k]) ** 2 // p[k]).sum(1)
            there = np.flatnonzero((dense[k] > 0) & (p[k] > q))
            value = (p[k][there] - q[there]) ** 2 // q[there]
            best = np.lexsort((there, -value))[:TOP]
            ahead[k] = sorted([*ahead[k], *zip((-value[best]).tolist(), (there[best] + low).tolist(), strict=True)])[:TOP]
    out = [(sources[j], "pair", sources[k], int(apart[j, k])) for j in range(len(sources)) for k in range(len(sources)) if j != k]
    out += [(s, "term", kept[i].decode(), -v) for s, best in zip(sources, ahead, strict=True) for v, i in best]
    source, part, item, value = zip(*out, strict=True) if out else ((), (), (), ())
    kinds = [(source, pa.string()), (part, pa.string()), (item, pa.string()), (value, pa.int64())]
    return pa.table([pa.array([lang] * len(out), pa.string()), *[pa.array(a, k) for a, k in kinds]], ["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part ``pair`` compares a source with each other one of its language,
    part ``term`` gives the TOP terms in which a source is ahead of its language.

    A share p is 1 + floor(WHOLE * (count + 1) / (N + V)), N being a group's count of all kept terms and V their number;
    the value of a term is floor((p - q) * (p - q) / q), that of a pair their sum. Ranks follow value, then item.

    Null texts, languages and sources are empty ones. Every group that occurs is compared, even without terms; a language of
    one source has no pairs; one without kept terms has pairs of value 0. Ties of value are ordered by the item's UTF-8 bytes.
    Repeated rows are documents of their own. Texts and terms of any length are read whole. No rows give none; ids and further
    columns aren't read, whatever their names.

    A worker holds TERMS_HELD terms and one document's, or a chunk of CHUNK_ROWS rows or all sources of one term.
    Two tables are written, which the result reads.
    """
    named = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*named).mapInArrow(_count, "lang string, source string, term string, docs long, times long")
    counts = materialize(found.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times")), "terms")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.where("term is not null").withColumn("in_docs", F.sum("docs").over(of_term)).where(F.col("in_docs") >= least_docs)
    kept = materialize(kept.select("lang", "source", "term", "times"), "kept-terms")

    by_term = kept.groupBy("lang", "term").agg(F.sum("times").alias("times"), F.count("*").alias("n_rows"))
    langs = by_term.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("times").alias("lang_times"), F.sum("n_rows").alias("n_rows"))
    langs = materialize(langs.withColumn("chunks", F.ceil(F.col("n_rows") / CHUNK_ROWS).cast("long")).withColumnRenamed("lang", "of"), "languages")
    langs = F.broadcast(langs) if langs.count() <= FEW_LANGS else langs

    own = kept.groupBy("lang", "source").agg(F.sum("times").alias("n_times")).withColumnsRenamed({"lang": "l", "source": "s"})
    groups = counts.where("term is null").join(own, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")), "left").join(langs, F.col("lang") == F.col("of"), "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_times", "n_terms", "lang_times")} | {"chunks": F.coalesce("chunks", F.lit(1).cast("long"))}
    groups = groups.withColumns(zero).select("lang", "source", "n_times", "n_terms", "lang_times", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    dealt = kept.join(langs.select("of", "chunks"), F.col("lang") == F.col("of")).withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")))
    dealt = dealt.select("lang", "chunk", "source", "term", "times")
    parts = dealt.groupBy("lang", "chunk").cogroup(groups.groupBy("lang", "chunk")).applyInArrow(_chunk, "lang string, source string, part string, item string, value long")
    total = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = total.withColumn("rank", rank.cast("int")).where((F.col("part") == "pair") | (F.col("rank") <= TOP))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
