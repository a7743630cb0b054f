"""Secret scans by a trigram index.

Each rule's regular expression gives a Boolean query over the trigrams that any match must
hold. One pass over the texts makes postings (trigram, document) for the trigrams that some
rule asks for; intersecting and uniting postings gives each rule's candidate documents, and
only those are verified with the rule itself. Rules without mandatory trigrams scan all texts.

Main path: DataFrame functions only. The queries are derived on the driver, from the rules alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import computed_once, folded, materialize, whole_text

_parser = re._parser


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost and not overlapping, of which those stay whose ``group`` has
    ``least`` code points at least. Java, Python and RE2 must agree on the pattern, so letters in either case are
    classes: a flag for that lets some engines take U+017F for s and U+212A for k."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1



def either_case(pattern: str) -> str:
    """The pattern with each letter as a class of both its cases."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


#: The base rules, in the order that breaks ties. A hexadecimal run below 16 digits can't
#: be a match, and a match is always a whole run, so the least length stands in the pattern.
BASE = [
    Rule("assign", f"({either_case('password|passwd|secret|token|api_?key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
]
#: Further public formats of keys.
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abp]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]

#: A query in disjunctive form: any of the sets of trigrams, all of the set. The empty set asks for nothing.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])
MOST_STRINGS, MOST_CLAUSES = 24, 64


def _simplest(q: Query) -> Query:
    """Without clauses that a weaker clause covers; ANY if it grows too large to be worth asking."""
    q = frozenset(a for a in q if not any(b < a for b in q))
    return q if len(q) <= MOST_CLAUSES else ANY


def _both(a: Query, b: Query) -> Query:
    return _simplest(frozenset(x | y for x in a for y in b))


def _of_strings(strings: set[str]) -> Query:
    return _simplest(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _class_members(items) -> set[str] | None:
    """The lower-cased characters of a class, or None if there are too many or not known."""
    out: set[str] = set()
    for op, arg in items:
        if op is _parser.LITERAL:
            out.add(chr(arg).lower())
        elif op is _parser.RANGE and arg[1] - arg[0] < 8:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 5 else None


def _walk(tree) -> tuple[set[str] | None, Query]:
    """(all strings that the pattern matches, lower-cased, or None if they are too many; a query any match fulfils)."""
    current, query, exact = {""}, ANY, True
    for op, arg in tree:
        strings, own = None, ANY
        if op is _parser.LITERAL:
            strings = {chr(arg).lower()}
        elif op is _parser.IN:
            strings = _class_members(arg)
        elif op is _parser.SUBPATTERN:
            strings, own = _walk(arg[3])
        elif op is _parser.BRANCH:
            parts = [_walk(x) for x in arg[1]]
            own = _simplest(frozenset().union(*[_of_strings(s) if s is not None else q for s, q in parts]))
            if all(s is not None for s, _ in parts):
                strings = set().union(*[s for s, _ in parts])
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT, _parser.POSSESSIVE_REPEAT):
            low, high, inner = arg
            strings, own = _walk(inner)
            if strings is not None and high <= 3:
                strings = {"".join(p) for n in range(low, high + 1) for p in product(sorted(strings), repeat=n)}
            else:  # what is repeated stands there once at least, or perhaps not at all
                own = ANY if low == 0 else own if strings is None else _of_strings(strings)
                strings = None
        elif op is _parser.AT:
            strings = {""}
        if strings is not None and len(strings) * len(current) <= MOST_STRINGS:
            current = {a + b for a in current for b in strings}
            continue
        query = _both(query, _of_strings(current))
        if strings is not None and len(strings) <= MOST_STRINGS:
            current, exact = strings, False
        else:
            query = _both(query, own if strings is None else _of_strings(strings))
            current, exact = {""}, False
    return (current if exact else None), _both(query, _of_strings(current)) if not exact else _of_strings(current)


def trigram_query(pattern: str) -> Query:
    """A query over lower-cased trigrams that every match of ``pattern`` fulfils; ANY if none is mandatory.

    Strings of up to three trigram-less characters, classes of many members and optional parts ask for nothing.
    """
    return _walk(_parser.parse(pattern))[1]


def candidates(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, digest, kinds): for each document, the rules with mandatory trigrams whose queries it fulfils."""
    asked = [(r.kind, n, t, len(c)) for r in rules for n, c in enumerate(sorted(trigram_query(r.pattern), key=sorted)) for t in sorted(c)]
    trigrams = sorted({t for _, _, t, _ in asked})
    spark = rows.sparkSession
    low = computed_once(rows, low=F.lower("body"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    postings = low.select("doc_id", "digest", F.explode(found).alias("trigram"))
    # as large as the rules: a few hundred rows at most
    clauses = F.broadcast(spark.createDataFrame(asked, "kind string, clause int, trigram string, needed int"))
    met = postings.join(clauses, "trigram").groupBy("doc_id", "digest", "kind", "clause", "needed")
    met = met.agg(F.count_distinct("trigram").alias("n")).where("n = needed")
    return met.groupBy("doc_id", "digest").agg(F.collect_set("kind").alias("kinds"))


def _parts(rule: Rule, wanted: Column) -> Column:
    """For each match of the rule in ``body``, in order: the text before it and the match, in code points and bytes, and its value's length."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all("body", pattern, F.lit(0))
    values = F.regexp_extract_all("body", pattern, F.lit(rule.group)) if rule.group else matches
    sizes = lambda a: F.transform(a, lambda x: F.struct(F.length(x).alias("chars"), F.octet_length(x).alias("bytes")))
    # the texts between matches give the matches' places; the last one has no match after it
    before = F.slice(sizes(F.split("body", rule.pattern, -1)), 1, F.size(matches))
    parts = F.arrays_zip(before.alias("gap"), sizes(matches).alias("own"), F.transform(values, F.length).alias("value"))
    size = "struct<chars: int, bytes: int>"
    return F.when(wanted & (F.regexp_instr("body", pattern) > 0), parts).otherwise(F.array().cast(f"array<struct<gap: {size}, own: {size}, value: int>>"))


def _spans(rule: Rule, order: int, parts: Column) -> Column:
    """The rule's spans: an array of (start, order, end, kind, from_byte, to_byte), code points and bytes, ends exclusive."""

    def emit(at: Column, x: Column) -> Column:
        start, first = at["chars"] + x["gap"]["chars"], at["bytes"] + x["gap"]["bytes"]
        end, last = start + x["own"]["chars"], first + x["own"]["bytes"]
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind"), first.alias("from_byte"), last.alias("to_byte"))
        return F.when(x["value"] >= rule.least, span)

    add = lambda a, b: F.struct(*[(a[c] + b[c]).alias(c) for c in ("chars", "bytes")])
    zero = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("bytes"))
    return F.array_compact(folded(parts, zero, lambda at, x: add(add(at, x["gap"]), x["own"]), emit, add))


def scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", more: list[Rule] = MORE,
    keep: list[str] = (), broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """Find secrets in every whole text; one row for each row of ``docs``.

    Args:
        more: rules beside the base ones; their spans are added, base ones stay.
        keep: further columns of ``docs`` to carry through.
        broadcast_bytes: the candidate list goes to all executors only if its counted size is below this;
            above it, texts and candidates meet by a shuffle.

    Returns doc_id, the carried columns as kept_<name>, body (the text), found: the spans, an array of
    (start, order, end, kind, from_byte, to_byte) by start; ties go by the order of the rules. Null texts count as empty and
    have none. Null ids and repeated rows are scanned like any other; no rows give no rows; columns that
    aren't named aren't read. Texts of any length are scanned whole, each by one task.
    """
    rules = [*BASE, *more]
    rows = docs.select(docs[id_column].alias("doc_id"), *[docs[c].alias(f"kept_{c}") for c in keep], whole_text(docs, text_column).alias("body"))
    rows = rows.withColumn("digest", F.xxhash64("body"))
    listed = [r for r in rules if trigram_query(r.pattern) != ANY]
    kinds = materialize(candidates(rows.select("doc_id", "body", "digest"), listed), "candidates")
    size = kinds.count() * 128
    kinds = kinds.select(F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest"), "kinds")
    kinds = F.broadcast(kinds) if size <= broadcast_bytes else kinds
    rows = rows.join(kinds, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("digest") == F.col("of_digest")), "left")
    asked = lambda r: F.coalesce(F.array_contains("kinds", r.kind), F.lit(False)) if r in listed else F.lit(True)
    rows = computed_once(rows, **{f"parts_{n}": _parts(r, asked(r)) for n, r in enumerate(rules)}).drop("kinds", "of_id", "of_digest", "digest")
    parts = [F.col(f"parts_{n}") for n in range(len(rules))]
    spans = [F.when(F.size(p) > 0, _spans(r, n, p)) for n, (r, p) in enumerate(zip(rules, parts, strict=True))]
    found = F.when(sum(map(F.size, parts[1:]), F.size(parts[0])) > 0, F.array_sort(F.flatten(F.array_compact(F.array(*spans)))))
    none = F.array().cast("array<struct<start: int, order: int, end: int, kind: string, from_byte: int, to_byte: int>>")
    return computed_once(rows, found=F.coalesce(found, none)).drop(*[f"parts_{n}" for n in range(len(rules))])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of what ``scan`` returns."""
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("found", lambda s: s["order"] < len(BASE))
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def redacted(mark: str = "[SECRET]") -> Column:
    """``body`` with each run of overlapping spans of ``found`` replaced by ``mark``."""
    raw = F.col("body").cast("binary")
    between = lambda a, b: F.substring(raw, a + 1, b - a).cast("string")  # noqa: E731  a slice of bytes, wherever it is
    # before a span that doesn't overlap with an earlier one: the text from the last end on
    pieces = folded(
        F.col("found"), F.lit(0), lambda at, s: F.greatest(at, s["to_byte"]),
        lambda at, s: F.when(s["from_byte"] >= at, F.concat(between(at, s["from_byte"]), F.lit(mark))), lambda a, b: F.greatest(a, b),
    )
    end = F.array_max(F.transform("found", lambda s: s["to_byte"]))
    whole = F.concat(F.array_join(F.array_compact(pieces), ""), between(end, F.octet_length("body")))
    return F.when(F.size("found") == 0, F.col("body")).otherwise(whole)
