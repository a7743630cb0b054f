"""The pipeline and the queries over sf0.001, held against brute force."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from tagweave.llm import queries  # noqa: E402

from .test_operators import counted, linked_components, secrets_of, shingles, squeezed  # noqa: E402


def test_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text or "" for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality rules", "exact dedup", "near dedup", "secret scans", "packing"]

    def after(name, docs):
        from tagweave.llm.common import materialize

        out = materialize(steps[name](spark, docs, sf), "test")
        assert out.columns == columns
        return out, {r.doc_id: r.text for r in out.collect()}

    docs, good = after("quality rules", docs)
    base = {i for i, t in texts.items() if (c := counted(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    assert set(good) <= base and len(good) > 0.8 * len(base)
    for i, t in good.items():  # lines may be gone; those that are left stand in their order
        left = iter(texts[i].split("\n"))
        assert t == texts[i] or all(line in left for line in t.split("\n"))

    docs, once = after("exact dedup", docs)
    groups = defaultdict(list)
    for i, t in good.items():
        groups[squeezed(t)].append(i)
    assert set(once) == {min(g) for g in groups.values()}

    docs, apart = after("near dedup", docs)
    roots = linked_components({i: shingles(t, 5) for i, t in once.items()}, 80)
    assert set(apart) == set(roots.values())

    docs, hidden = after("secret scans", docs)
    assert set(hidden) == set(apart)
    for i, t in hidden.items():
        assert (t == apart[i]) == (not secrets_of(apart[i])) and not secrets_of(t)

    packed = steps["packing"](spark, docs, sf).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == cut_pieces(hidden)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    assert len(sequences) <= 1.02 * -(-sum(r.length for r in packed) // 2048) + 1


def cut_pieces(texts):
    """(doc_id, piece, start, length, crc) of every text by the library."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tok, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, t in texts.items():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out += [(i, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
    return sorted(out)


def test_queries_against_the_libraries_and_brute_force(spark, sf):
    import public_tokenizers
    import sentencepiece

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = {i: np.array(sp.encode(t), "<u4") for i, t in texts.items()}
    counts = queries.QUERIES["op1_token_counts"](spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in counts} == {i: (len(texts[i].encode()), len(x), len(x) > 4096) for i, x in ids.items()}
    coded = queries.QUERIES["op5_sentencepiece"](spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32, r.round_trip, r.mismatches) for r in coded} == {i: (len(x), zlib.crc32(x.tobytes()), "▁" not in texts[i], 0) for i, x in ids.items()} | {
        r.doc_id: (r.n_tokens, r.ids_crc32, True, 0) for r in coded if "▁" in texts[r.doc_id]
    }
    packed = queries.QUERIES["op4_packing"](spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == cut_pieces(texts)
    sets = {i: shingles(t, 4) for i, t in texts.items()}
    want = linked_components(sets, 80)
    near = queries.QUERIES["op3_near_dedup"](spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near} == {i: (len(s), want[i], want[i] == i) for i, s in sets.items()}


ODD = "doc_id long, text string, lang string, source string, n_chars long, gone string, key string, tokens string, row_number string"
LONG = " ".join(f"word{k * 7919 % 100003}" for k in range(30_000)) + "."


def odd_rows(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, None, "clash", "clash", "clash", "clash") for i, t in rows], ODD)


def test_stages_on_odd_tables(spark, sf):
    """Empty tables, nulls, repeated ids and rows, long texts, further columns."""
    steps = dict(corpus_pipeline.STAGES)
    for name, stage in steps.items():
        out = stage(spark, odd_rows(spark, []), sf)
        assert out.count() == 0 and (name == "packing" or out.columns == corpus_pipeline.COLUMNS)
    rows = [(1, None), (2, ""), (None, LONG), (3, LONG), (4, "a few words."), (4, "a few words.")]
    docs = odd_rows(spark, rows)
    assert sorted(r.doc_id or 0 for r in steps["quality rules"](spark, docs, sf).collect()) == [0, 3]
    kept = steps["exact dedup"](spark, docs, sf)
    assert kept.columns == corpus_pipeline.COLUMNS and sorted(r.text or "" for r in kept.collect()) == ["", LONG, "a few words."][:1] + sorted([LONG, "a few words."])
    assert sorted((r.text or "")[:5] for r in steps["near dedup"](spark, docs, sf).collect()) == sorted(["", "", "a few", LONG[:5]])
    assert steps["secret scans"](spark, docs, sf).count() == len(rows) and steps["packing"](spark, docs, sf).select("doc_id").distinct().count() == 5


def test_repeated_ids_lose_no_text(spark, sf):
    steps = dict(corpus_pipeline.STAGES)
    x, y, z = (" ".join(f"{c}{k}" for k in range(60)) for c in "xyz")
    docs = odd_rows(spark, [(1, x), (5, x), (5, y), (7, z), (7, z), (None, y)])
    for name in ("exact dedup", "near dedup"):
        assert sorted(r.text for r in steps[name](spark, docs, sf).collect()) == sorted([x, y, z]), name
    closer = odd_rows(spark, [(5, x), (5, y), (9, x.replace("x59", "odd"))])
    assert len([r for r in steps["near dedup"](spark, closer, sf).collect()]) == 2


def test_run_over_no_documents(spark, tmp_path):
    odd_rows(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_is_its_stages(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {"doc_id", "sequence_id", "offset", "length"} <= set(rows[0].asDict())


def test_every_operator_has_a_query(spark, sf):
    numbers = {int(m[1]) for q in queries.QUERIES if (m := re.match(r"op(\d+)_", q))}
    assert numbers == set(range(1, 14))
    for name, f in queries.QUERIES.items():
        table = {"op10": "pages", "op11": "embeddings"}.get(name.split("_")[0], "documents")
        whole = spark.read.parquet(f"{sf}/{table}.parquet").count()
        n = f(spark, sf).count()
        # pieces, and reports on sources, aren't rows of the table
        assert n >= whole if name in ("op4_packing", "op12_source_audit") else n == whole, name
