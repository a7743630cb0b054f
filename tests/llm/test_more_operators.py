"""Vector codes, source audit and n-gram join, held against brute force, with odd rows and small limits."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagweave.llm import ngram_join, queries, source_audit, vector_codes

WORDS = [f"w{k}" for k in range(400)]


def plain_lloyd(x, parts, entries, rounds):
    """Codes and codebooks by measuring everything."""
    w = x.shape[1] // parts
    books = np.stack([x[:entries, p * w : (p + 1) * w] for p in range(parts)])
    for n in range(rounds + 1):
        d2 = np.stack([((x[:, None, p * w : (p + 1) * w] - books[p]) ** 2).sum(2) for p in range(parts)], 1)
        code = d2.argmin(2)
        if n < rounds:
            books = books.copy()
            for p in range(parts):
                for k in set(code[:, p].tolist()):
                    own = x[code[:, p] == k, p * w : (p + 1) * w]
                    books[p, k] = own.sum(0) // len(own)
    return code, d2.min(2).sum(1), books


@pytest.mark.parametrize("seed", [1, 2])
def test_vector_codes_match_plain_rounds(spark, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(9, 16))
    x = [(centres[r.integers(9)] + r.normal(size=16) * 0.02).astype(np.float32).tolist() for _ in range(600)]
    x[40:60] = [x[3]] * 20  # equal vectors: equal entries, of which the first is used
    x[100] = [1e30] + x[100][1:]  # held at the largest integer
    vectors = spark.createDataFrame([(n, v, None if n % 5 == 0 else n % 3, "x") for n, v in enumerate(x)], "vec_id long, embedding array<float>, label int, code string").repartition(3)
    coded, books = vector_codes.compress(vectors, parts=4, entries=24, rounds=3)
    limit = vector_codes.most(16)
    whole = np.clip(np.floor(256 * np.array(x, np.float32).astype(np.float64)), -limit, limit).astype(np.int64)
    code, error, want = plain_lloyd(whole, 4, 24, 3)
    assert (books == want).all()
    got = {r.vec_id: r for r in vector_codes.digests(coded, books).collect()}
    assert len(got) == len(x)
    sums = defaultdict(int)
    for n in range(len(x)):
        sums[None if n % 5 == 0 else n % 3] += int(error[n])
    for n in range(len(x)):
        assert got[n].code == bytes(code[n].tolist()).hex() and got[n].error == error[n]
        assert got[n].label_error == sums[None if n % 5 == 0 else n % 3]


def test_vector_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[float(n % 3), float(n), -0.25, 0.001] for n in range(6)]
    rows = [(n, v, 1) for n, v in enumerate(good)] + [(2, good[5], None), (None, good[0], 1)]
    bad = [(90, None, 1), (91, [1.0, None, 0.0, 0.0], 1), (92, [nan, 0.0, 0.0, 0.0], 1), (93, [0.0, -inf, 0.0, 0.0], 1), (94, [], 1), (95, [1.0, 2.0, 3.0], 1), (96, [1.0, 2.0], 1)]
    vectors = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")
    coded, books = vector_codes.compress(vectors, parts=2, entries=64)
    out = vector_codes.digests(coded, books).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in out) == [(False, n) for n in (0, 1, 2, 2, 3, 4, 5)] + [(True, 0)]
    assert books.shape == (2, 8, 2)
    # repeated ids: the lesser vector first; null ids last
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    code, error, _ = plain_lloyd(np.floor(256 * np.array([v for _, v, _ in order])).astype(np.int64), 2, 8, 2)
    assert Counter((r.vec_id, r.code, r.error) for r in out) == Counter((i, bytes(c.tolist()).hex(), e) for (i, _, _), c, e in zip(order, code, error.tolist(), strict=True))
    assert vector_codes.digests(*vector_codes.compress(vectors.where("1 = 0"))).count() == 0
    assert vector_codes.digests(*vector_codes.compress(vectors.where("vec_id >= 90"), parts=16)).count() == 0


def test_few_distances_are_measured_again():
    r = np.random.default_rng(7)
    x = (r.integers(0, 20, (4000, 1)) * 1000 + r.integers(-30, 30, (4000, 4))).astype(np.int64)
    entries = x[:20].copy()
    code, _, upper, low, scale = vector_codes.first_part(x, entries)
    found = vector_codes.next_part(x, entries + 1, np.full(20, 2.0), code, upper, low * scale[:, None].astype(float) * (1 - vector_codes.SLACK))
    assert (found[0] == vector_codes.squares(x, entries + 1).argmin(1)).all()
    assert found[5] < 0.5 * x.shape[0] * 19


def test_squares_of_large_integers():
    x, e = np.array([[3 << 27, -5], [1, 2]], np.int64), np.array([[-(3 << 27), 7], [1, 2]], np.int64)
    assert vector_codes.squares(x, e).tolist() == [[int(sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True))) for q in e] for p in x]


def plain_audit(docs, least=3):
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    in_docs, times, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        found = term.findall((text or "").translate(lower))
        groups[lang].add(source)
        in_docs[lang].update(set(found))
        times[lang, source].update(found)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        share = {}
        for s in [*sources, None]:
            own = sum((times[lang, x] for x in sources), Counter()) if s is None else times[lang, s]
            total = sum(own[t] for t in kept) + len(kept)
            share[s] = {t: 1 + 10**9 * (own[t] + 1) // total for t in kept}
        for s in sources:
            p, q = share[s], share[None]
            pairs = [(sum((p[t] - share[o][t]) ** 2 // share[o][t] for t in kept), o) for o in sources if o != s]
            ahead = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if times[lang, s][t] and p[t] > q[t]]
            for part, found in (("pair", pairs), ("term", ahead)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (v, i) in enumerate(found) if part == "pair" or n < 200]
    return Counter(out)


@pytest.mark.parametrize("rows", [7, 100_000])
def test_source_audit(spark, monkeypatch, rows):
    monkeypatch.setattr(source_audit, "CHUNK_ROWS", rows)
    r = random.Random(4)
    names = [*"abcdefgh", "é", "naïve", "日本", "\U0001f600x", *[f"t{k}" for k in "ijklmnop"], "x" * 5000]
    docs = [(" ".join(r.choice(names[: 5 + 3 * (k % 5)]) for _ in range(r.randrange(40))), ["en", None, "日"][k % 7 % 3], ["a", "a", "b", None, "é", "z"][k % 6]) for k in range(150)]
    docs += [(None, "en", "a"), ("", "en", "no terms"), ("12 34 @[`{~", "xx", "q"), (None, "xx", "r"), ("ONE One one", "alone", None), ("a" * 20_000 + " b", "en", "b"), docs[3], docs[3]]
    table = spark.createDataFrame(docs, "text string, lang string, source string").withColumns({c: F.lit("x") for c in ("term", "docs", "times", "chunk", "of", "doc_id")})
    out = source_audit.audit(table.repartition(3))
    assert Counter(map(tuple, out.collect())) == plain_audit(docs)
    assert source_audit.audit(table.where("1 = 0")).count() == 0


def test_source_audit_in_small_steps(monkeypatch):
    monkeypatch.setattr(source_audit, "TERMS_HELD", 3)
    monkeypatch.setattr(source_audit, "CELLS", 4)
    docs = [("a b c d e f a", "l", "s"), ("a b c c c x y z", "l", "t"), ("b c d z z", "l", "t"), ("a c f", "l", "u")] * 3
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": a, "source": s} for t, a, s in docs])
    times, in_docs = Counter(), Counter()
    for found in source_audit._count(iter([batch])):
        for row in found.to_pylist():
            if row["term"] is not None:
                times[row["source"], row["term"]] += row["times"]
                in_docs[row["term"]] += row["docs"]
    kept = [t for t, n in in_docs.items() if n >= 3]
    rows = [{"source": s, "term": t, "times": n} for (s, t), n in times.items() if t in kept]
    own = Counter()
    for x in rows:
        own[x["source"]] += x["times"]
    groups = [{"lang": "l", "source": s, "n_times": own[s], "n_terms": len(kept), "lang_times": sum(own.values())} for s in ("u", "s", "t")]
    out = source_audit._chunk(pa.Table.from_pylist(rows), pa.Table.from_pylist(groups)).to_pylist()
    want = plain_audit(docs)
    assert {(x["source"], x["part"], x["item"], x["value"]) for x in out} == {k[1:5] for k in want}


def test_shares_are_exact():
    for count, total in [(0, 1), (2**52, 2**53 - 1), (10**15, 10**15 + 1), (7, 9 * 10**15), (123456789, 987654321987)]:
        assert source_audit.shares(np.array([count]), np.array([total]))[0] == 1 + 10**9 * (count + 1) // total


def plain_join(docs, percent=85, width=4):
    """(size, component) of each (id, text), by an inverted index of all shingles."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets, holders = [], defaultdict(list)
    for n, (_, text) in enumerate(docs):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
        for s in sets[-1]:
            holders[s].append(n)
    parent = list(range(len(docs)))

    def root(k):
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for n, own in enumerate(sets):
        shared = Counter(m for s in own for m in holders[s] if m < n)
        for m, c in shared.items():
            if 100 * c >= percent * (len(own) + len(sets[m]) - c):
                parent[root(m)] = root(n)
    least = {}
    for n, (i, _) in enumerate(docs):
        least[root(n)] = min(i, least.get(root(n), i))
    return {i: (len(s), least[root(n)]) for n, ((i, _), s) in enumerate(zip(docs, sets, strict=True))}


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_ngram_join_over_whole_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op13_ngram_join(spark, sf_dir).collect()}
    assert out == plain_join(docs)


def near_copies(seed):
    """Documents near the threshold: copies of copies, parts, common passages, large groups, few words."""
    r, docs = random.Random(seed), []
    passage = " ".join(r.choice(WORDS) for _ in range(60))
    for _ in range(12):
        words = [r.choice(WORDS) for _ in range(r.randrange(20, 160))]
        for _ in range(r.choice([2, 3, 30])):
            own = list(words)
            for _ in range(r.randrange(0, 4)):
                own[r.randrange(len(own))] = r.choice(WORDS)
            docs.append(" ".join(own[r.randrange(3) : len(own) - r.randrange(12)]))
            words = own if r.random() < 0.3 else words
    docs += [f"{passage} {r.choice(WORDS)} {' '.join(r.choice(WORDS) for _ in range(n))}" for n in range(0, 60, 2)]
    docs += ["a b", "A  b", "a b c", "one", "one", "", " \n", "a b c d", "x " * 50, "x " * 90]
    r.shuffle(docs)
    return [(n * 3 + 1, t) for n, t in enumerate(docs)]


@pytest.mark.parametrize("seed, long, surely, tile", [(1, 48, 16_384, 1024), (2, 2, 16_384, 8), (3, 4, -1, 16), (4, 2, 6, 1024)])
def test_ngram_join_finds_all_links(spark, monkeypatch, seed, long, surely, tile):
    """Also with limits so low that most columns are long, are known to be, or are multiplied in many tiles."""
    for name, value in (("LONG", long), ("SURELY_LONG", surely), ("TILE", tile), ("SPAN", 64)):
        monkeypatch.setattr(ngram_join, name, value)
    docs = near_copies(seed)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(table).collect()}
    assert got == plain_join(docs)


def test_ngram_join_of_odd_rows(spark):
    long_text = " ".join(WORDS[k % 397] + str(k % 11) for k in range(30_000))
    docs = [(1, long_text), (2, long_text + " more words at the end"), (3, None), (4, ""), (5, "\n"), (7, "only three words"), (8, "ONLY  three\nwords"), (9, "naïve É é words here"), (10, "naïve É É words here")]
    repeated = [(8, "something else with a number of words"), (20, "something else with a number of words"), (None, long_text)]
    table = spark.createDataFrame(docs + repeated, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "n", "entries", "print", "part", "counts", "rep", "node", "key", "lang")})
    out = ngram_join.ngram_join(table).collect()
    assert len(out) == len(docs) + len(repeated)
    ids = defaultdict(set)
    for r in out:
        ids[r.doc_id].add(r.component_id)
    assert ids[2] == {1} and ids[3] == {3} and ids[4] == {4} and ids[5] == {5} and ids[10] == {10} and ids[None] == {None}
    assert ids[7] == ids[8] == ids[20] == {7}  # rows that repeat an id share its component
    assert ngram_join.ngram_join(table.where("1 = 0")).count() == 0


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_source_audit"])
def test_queries_match_their_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = con.execute(queries.SQL[name])
    columns = [d[0] for d in found.description]
    assert Counter(found.fetchall()) == Counter(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, sf).collect())
