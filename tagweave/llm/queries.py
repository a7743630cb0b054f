"""The queries of this subpackage, each applying its operator to its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import (
    exact_dedup,
    license_scans,
    near_dedup,
    ngram_join,
    packing,
    quality_rules,
    secret_scans,
    sentencepiece_codec,
    sharding,
    source_audit,
    token_counts,
    url_filters,
    vector_codes,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the public tokenizers' files are on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.digests(secret_scans.scan(_table(spark, sf_dir, "documents")))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packing.pack(cut)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", "ids_crc32", "round_trip", "mismatches")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scans.scan(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(_table(spark, sf_dir, "pages"), url_filters.listed_urls(spark)).select(
        "page_id", "host", "path", "canonical", "rule", "listed", "verdict"
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digests(*vector_codes.compress(_table(spark, sf_dir, "embeddings")))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(_table(spark, sf_dir, "documents"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_secret_scans": op2_secret_scans,
    "op3_near_dedup": op3_near_dedup,
    "op4_packing": op4_packing,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_sharding": op6_sharding,
    "op7_quality_rules": op7_quality_rules,
    "op8_license_scans": op8_license_scans,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_url_filters": op10_url_filters,
    "op11_vector_codes": op11_vector_codes,
    "op12_source_audit": op12_source_audit,
    "op13_ngram_join": op13_ngram_join,
}

WORD = r"[^\x20\x09-\x0D]+"
_quoted = lambda x: x.replace("'", "''")
_RULES = [*secret_scans.BASE, *secret_scans.MORE]
#: The texts between matches and the matches in turn give the matches' places.
OP2_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(
    f"SELECT doc_id, {n} AS ord, '{r.kind}' AS kind, {r.least} AS least, "
    f"list_transform(regexp_extract_all(t, '{_quoted(r.pattern)}'), lambda x: length(x)) AS lens, "
    f"list_transform(regexp_extract_all(t, '{_quoted(r.pattern)}', {r.group}), lambda x: length(x)) AS sizes, "
    f"list_transform(regexp_split_to_array(t, '{_quoted(r.pattern)}'), lambda x: length(x)) AS gaps "
    f"FROM d WHERE regexp_matches(t, '{_quoted(r.pattern)}')" for n, r in enumerate(_RULES))}),
p AS (SELECT *, unnest(range(1, len(lens) + 1)) AS i FROM m),
s AS (
  SELECT doc_id, ord, kind, list_sum(gaps[1:i]) + coalesce(list_sum(lens[1:i - 1]), 0) AS a, lens[i] AS n
  FROM p WHERE sizes[i] >= least),
g AS (
  SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
         string_agg(kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT, ',' ORDER BY a, ord) FILTER (ord < {len(secret_scans.BASE)}) AS base,
         string_agg(kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT, ',' ORDER BY a, ord) AS spans
  FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""

_LOW = "lower(l)"
_BARS = f"length(regexp_replace(l, '[^{quality_rules.BARS}]+', '', 'g'))"
_COUNT = f"len(regexp_extract_all(l, '{WORD}'))"
_FAILING = rf"""
           ({_BARS} >= 2 AND {_BARS} * 5 >= {_COUNT})
           OR ({_COUNT} <= {quality_rules.TINY} AND regexp_matches({_LOW}, '^[\x20\x09-\x0D]*({"|".join(quality_rules.MENU)})[\x20\x09-\x0D]*$'))
           OR length(regexp_replace(l, '[^{quality_rules.ODD}]+', '', 'g')) * 4 >= length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g'))
           OR NOT regexp_matches(l, '[A-Za-z0-9\x{{80}}-\x{{10FFFF}}]')
           OR ({_COUNT} <= {quality_rules.TINY} AND NOT regexp_matches(l, '[{_quoted(quality_rules.ENDS)}][\x20\x09-\x0D]*$'))
           OR ({_COUNT} <= {quality_rules.SHORT} AND regexp_matches({_LOW}, '{"|".join(quality_rules.BOILERPLATE)}'))"""
OP7_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM d),
g AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 3) AS s(k) GROUP BY doc_id),
x AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         list_filter(lines, lambda l: {_FAILING}) AS removed
  FROM w),
y AS (
  SELECT x.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         len(removed) AS n_lines_removed,
         len(regexp_extract_all(array_to_string(removed, chr(10)), '{WORD}')) AS n_words_lost
  FROM x LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_lines_removed::BIGINT AS n_lines_removed, n_words_lost::BIGINT AS n_words_lost,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (100 * n_words_lost > 30 * n_words) AS kept
FROM y
"""

def _standing(phrase: str) -> str:
    words = phrase.split()
    return "list_filter(range(1, len(w) + 1), lambda i: " + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words)) + ")"


_T = license_scans.TEMPLATES
_found = lambda n, t: f"(len(p{n}) > 0" + "".join(f" AND len({_standing(k)}) > 0" for k in t.keys) + ")"
_labels = lambda base: "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(
    f"CASE WHEN f{n} THEN '{t.label}' END" for n, t in enumerate(_T) if t.base or not base
) + "], lambda x: x IS NOT NULL))), ',')"
_base_places = "flatten([" + ", ".join(f"p{n}" for n, t in enumerate(_T) if t.base) + "])"
OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
p AS (SELECT doc_id, w, {", ".join(f"{_standing(t.words)} AS p{n}" for n, t in enumerate(_T))} FROM d),
f AS (SELECT *, {", ".join(f"{_found(n, t)} AS f{n}" for n, t in enumerate(_T))}, {_base_places} AS b FROM p)
SELECT doc_id, len(w)::BIGINT AS n_words, len(b)::BIGINT AS n_base, (list_min(b) - 1)::BIGINT AS first_word, (list_max(b) - 1)::BIGINT AS last_word,
       {_labels(True)} AS base_labels, {_labels(False)} AS labels,
       round(1 - {" * ".join(f"(CASE WHEN f{n} THEN 1 - {t.weight}::DOUBLE ELSE 1 END)" for n, t in enumerate(_T))}, 6)::DOUBLE AS score
FROM f
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size::BIGINT AS group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_rules = sorted(url_filters.RULES, key=lambda r: (-len(r), r))
_fits = lambda r: f"((host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}'))"
OP10_SQL = rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM u),
l AS (
  SELECT h || '/' || g || '/' || n AS url
  FROM unnest({_list(url_filters.LISTED_HOSTS)}) AS a(h), unnest({_list(url_filters.LISTED_LANGS)}) AS b(g), range({url_filters.LISTED_PAGES}) AS c(n)),
q AS (
  SELECT page_id, host, path, regexp_replace(host, '^(www|m|blog)\.', '') || regexp_replace(path, '(\.html|/)$', '') AS canonical,
         CASE {" ".join(f"WHEN {_fits(r)} THEN '{r}'" for r in _rules)} END AS rule
  FROM p)
SELECT page_id, host, path, canonical, rule, canonical IN (SELECT url FROM l) AS listed,
       CASE {" ".join(f"WHEN rule = '{k}' THEN '{v}'" for k, v in url_filters.RULES.items())}
            WHEN canonical IN (SELECT url FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM q
"""

_PARTS = vector_codes.PARTS


def _assigned(n: int) -> str:
    """Every part's nearest entry of codebook ``n``: one number that orders by distance, then index."""
    d = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"a{n} AS (SELECT r, parts.p, any_value(x) AS x, min({d}::HUGEINT * {vector_codes.ENTRIES} + i) AS best FROM parts JOIN c{n} ON parts.p = c{n}.p GROUP BY r, parts.p)"


def _entries(n: int) -> str:
    """Codebook ``n`` from the assignment before: floors of means, and the old entries that nothing chose."""
    return f"""m{n} AS (SELECT p, i, list(((s - ((s % k) + k) % k) // k)::BIGINT ORDER BY j) AS c FROM (
    SELECT p, best % {vector_codes.ENTRIES} AS i, j, sum(x[j]) AS s, count(*) AS k FROM a{n - 1}, range(1, len(x) + 1) AS t(j) GROUP BY ALL) GROUP BY p, i),
c{n} AS (SELECT b.p, b.i, coalesce(m.c, b.c) AS c FROM c{n - 1} AS b LEFT JOIN m{n} AS m ON b.p = m.p AND b.i = m.i)"""


OP11_SQL = rf"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, p, v[p * (len(v) // {_PARTS}) + 1 : (p + 1) * (len(v) // {_PARTS})] AS x FROM k, range({_PARTS}) AS t(p)),
c0 AS (SELECT p, r - 1 AS i, x AS c FROM parts WHERE r <= {vector_codes.ENTRIES}),
{_assigned(0)},
{_entries(1)},
{_assigned(1)},
{_entries(2)},
{_assigned(2)},
o AS (SELECT r, string_agg(printf('%02x', (best % {vector_codes.ENTRIES})::INTEGER), '' ORDER BY p) AS code, sum(best // {vector_codes.ENTRIES})::BIGINT AS error FROM a2 GROUP BY r),
e AS (SELECT label, sum(error)::BIGINT AS label_error FROM k JOIN o USING (r) GROUP BY label),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, i)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM k JOIN o USING (r) JOIN e ON k.label IS NOT DISTINCT FROM e.label, h
"""

_share = lambda count, total: f"1 + ({source_audit.WHOLE}::HUGEINT * ({count} + 1)) // {total}"
OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS times FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {source_audit.LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(times) AS n FROM k GROUP BY lang),
c AS (SELECT w.lang, source, w.term, count(*) AS times FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
n AS (SELECT lang, source, sum(times) AS n FROM c GROUP BY ALL),
s AS (
  SELECT g.lang, g.source, k.term, coalesce(c.times, 0) AS times, {_share("coalesce(c.times, 0)", "(coalesce(n.n, 0) + v.v)")} AS p, {_share("k.times", "(v.n + v.v)")} AS q
  FROM g JOIN k ON g.lang = k.lang JOIN v ON g.lang = v.lang
  LEFT JOIN n ON g.lang = n.lang AND g.source = n.source LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM s AS a JOIN s AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON a.lang = f.lang AND a.source = f.source AND b.source = f.item
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM s WHERE times > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
WHERE part = 'pair' OR rank <= {source_audit.TOP}
"""

SQL = {
    "op2_secret_scans": OP2_SQL,
    "op7_quality_rules": OP7_SQL,
    "op8_license_scans": OP8_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op10_url_filters": OP10_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_source_audit": OP12_SQL,
}
