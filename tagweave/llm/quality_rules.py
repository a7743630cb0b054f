"""Quality rules, lines first: punctuation, navigation and boilerplate rules judge each line; the lines
that fail are removed, and documents that lose too much of their text are rejected.

Main path: DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import SPACE, computed_once, whole_text

#: Phrases that make a short line boilerplate, in English, German, French and Spanish: patterns on which
#: Java and RE2 agree, over lower-cased lines.
BOILERPLATE = [
    "all rights reserved", "cookie policy", "privacy policy", "terms of (use|service)", "terms (and|&) conditions", "click here", "accept (all )?cookies",
    "(this|our) (web)?site uses cookies", "subscribe to our newsletter", "sign up for our newsletter", "enable javascript", "javascript is disabled", "lorem ipsum",
    "skip to (main )?content", "share this", "powered by [a-z]+", "page not found", "add to (cart|basket)", "follow us on",
    "alle rechte vorbehalten", "datenschutz(erkl[äÄ]rung|richtlinie)", "nutzungsbedingungen", "hier klicken", "klicken sie hier", "cookies akzeptieren", "newsletter abonnieren", "zum inhalt springen",
    "tous droits r[éÉ]serv[éÉ]s", "politique de confidentialit[éÉ]", "mentions l[éÉ]gales", "conditions d.utilisation", "cliquez ici", "accepter les cookies", "aller au contenu",
    "todos los derechos reservados", "pol[íÍ]tica de (privacidad|cookies)", "aviso legal", "t[éÉ]rminos de (uso|servicio)", "haga clic aqu[íÍ]", "aceptar (las )?cookies", "saltar al contenido",
]
#: What a line of a menu says alone, and the marks between the entries of one.
MENU = [
    "home", "menu", "search", "contact( us)?", "about( us)?", "log ?in", "sign (in|up)", "register", "next( page)?", "previous( page)?", "back to top", "read more", "share", "print", "sitemap",
    "startseite", "suche", "kontakt", "anmelden", "weiterlesen", "impressum", "accueil", "rechercher", "connexion", "lire la suite", "inicio", "buscar", "contacto", "leer m[áÁ]s",
]
BARS, ODD, ENDS = "|•»›·", r"#*$%&|<>{}\[\]=_~^", r""".!?…:;,"'”’»)\]。！？；」』）।؟"""
#: A line with so many words can be boilerplate, and with so few needs a mark at its end.
SHORT, TINY = 12, 3
#: Windows of so many words; positions of packed windows have so many bits.
WINDOW, PLACE_BITS = 3, 20


def repeated_words(words: str) -> Column:
    """Not for use alone: see ``_with_repeats``. Words standing in windows whose first words are ``places``."""
    places = F.col(words)
    gaps = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1), p + WINDOW) - p))
    return F.aggregate(gaps, F.lit(0), lambda a, b: a + b).cast("long")


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add n_repeat_words to rows with an array ``words``: words in 3-word windows that the text has twice or more.

    Windows are compared by 64-bit hashes of their text. Most texts repeat no window, which counting
    the distinct ones shows. For the others, (leading bits of the hash, place) are packed into one
    number each and sorted, which brings equal windows together; where leading bits agree but hashes
    don't, or a text is longer than the packed places allow, whole (hash, place) pairs are sorted.
    """
    rows = computed_once(rows, hashes=F.transform("words", lambda w: F.xxhash64(w)))
    last = F.size("words") - WINDOW
    window = lambda i: F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2))
    none = F.array().cast("array<bigint>")
    rows = computed_once(rows, windows=F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), window)).otherwise(none))
    rows = computed_once(rows.drop("hashes"), repeats=F.size(F.array_distinct("windows")) < F.size("windows"))
    low = F.lit((1 << PLACE_BITS) - 1).cast("long")
    packed = F.sort_array(F.transform("windows", lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))
    rows = computed_once(rows, packed=F.when(F.col("repeats") & (F.size("windows") <= 1 << PLACE_BITS), packed).otherwise(none))
    head = lambda x: F.shiftright(x, PLACE_BITS)
    full = lambda x: F.get("windows", x.bitwiseAND(low).cast("int"))
    at = lambda i: F.get("packed", i)
    # a neighbour with the same leading bits; null beyond the ends
    near = lambda x, i: F.coalesce(head(at(i - 1)) == head(x), F.lit(False)) | F.coalesce(head(at(i + 1)) == head(x), F.lit(False))
    rows = computed_once(rows, close=F.filter("packed", near))
    clash = lambda x, i: F.coalesce((head(F.get("close", i + 1)) == head(x)) & (full(F.get("close", i + 1)) != full(x)), F.lit(False))
    # size, not exists: a filter that is null-safe and cheap on the few that are close
    rows = computed_once(rows, whole=F.col("repeats") & ((F.size("windows") > 1 << PLACE_BITS) | (F.size(F.filter("close", clash)) > 0)))
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = computed_once(rows, pairs=F.when(F.col("whole"), pairs).otherwise(F.array().cast("array<struct<h: bigint, i: int>>")))
    pair = lambda i: F.get("pairs", i)["h"]
    same = lambda x, i: F.coalesce(pair(i - 1) == x["h"], F.lit(False)) | F.coalesce(pair(i + 1) == x["h"], F.lit(False))
    sorted_pairs = F.transform(F.filter("pairs", same), lambda x: x["i"])
    quick = F.transform("close", lambda x: x.bitwiseAND(low).cast("int"))
    rows = computed_once(rows, places=F.sort_array(F.when(F.col("whole"), sorted_pairs).otherwise(quick)))
    rows = rows.withColumn("n_repeat_words", repeated_words("places"))
    return rows.drop("windows", "repeats", "packed", "close", "whole", "pairs", "places")


def judged_lines(lines: Column) -> tuple[Column, Callable[[Column], Column]]:
    """What is asked of each of an array of lines, as an array of structs with the ``line``, and which of these are to go.

    Navigation: cells between bars, or what menus say alone. Punctuation: signs make up a quarter of it or all, or a few
    words have no mark at their end. Boilerplate: a phrase that says nothing of the text, in a short line.

    What several rules ask of a line is worked out once; most lines have no signs and many words, and are done with that.
    """
    signs = F.lit(f"[{BARS}{ODD}]")
    seen = F.transform(lines, lambda x: F.struct(x.alias("line"), F.regexp_count(x, F.lit(f"[^{SPACE}]+")).alias("words"), F.rlike(x, signs).alias("signs")))

    def fails(x: Column) -> Column:
        line, words = x["line"], x["words"]
        only = lambda kept: F.length(F.regexp_replace(line, f"[^{kept}]+", ""))
        bars, shape = only(BARS), F.length(F.regexp_replace(line, f"[{SPACE}]+", ""))
        by_signs = x["signs"] & (((bars >= 2) & (bars * 5 >= words)) | ((only(ODD) * 4 >= shape) & (shape > 0)))
        bare = (words > 0) & ~line.rlike(r"[A-Za-z0-9\x{80}-\x{10FFFF}]")
        low = F.lower(line)
        no_end = (words > 0) & ~line.rlike(f"[{ENDS}][{SPACE}]*$")
        tiny = (words <= TINY) & (no_end | low.rlike(f"^[{SPACE}]*({'|'.join(MENU)})[{SPACE}]*$"))
        return by_signs | bare | tiny | ((words <= SHORT) & low.rlike("|".join(BOILERPLATE)))

    return seen, fails


def failing_lines(lines: Column) -> Column:
    """Those of an array of lines that are to go."""
    seen, fails = judged_lines(lines)
    return F.transform(F.filter(seen, fails), lambda x: x["line"])


def judge(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_words: int = 50,
    most_repeat_percent: int = 50, most_lost_percent: int = 30, keep: list[str] = (), cleaned: bool = False,
) -> DataFrame:
    """Count and judge every text; one row for each row of ``docs``.

    Args:
        most_lost_percent: a document that loses more of its words than this to the line rules is rejected.
        keep: further columns of ``docs`` to carry through, for a filter on the verdict, as kept_<name>.
        cleaned: return ``cleaned`` too, the text without the lines that fail.

    Returns doc_id, the carried columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed (too few words, or too many in repeated windows), n_lines_removed, n_words_lost and
    kept (neither base_failed nor rejected for what the line rules removed).

    Null and empty texts have no words, so they fail; null ids, ties and repeated rows are judged like any
    other; no rows give no rows; columns that aren't named aren't read. A text is judged whole by one task,
    in memory of some ten times its size. No shuffle.
    """
    rows = docs.select(docs[id_column].alias("doc_id"), *[docs[c].alias(f"kept_{c}") for c in keep], whole_text(docs, text_column).alias("body"))
    rows = computed_once(
        rows, words=F.regexp_extract_all("body", F.lit(f"[^{SPACE}]+"), F.lit(0)),
        lines=F.filter(F.split("body", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")),
    )
    removed = failing_lines(F.col("lines"))
    if cleaned:  # every line's verdict, in order; lines without a word never fail
        seen, fails = judged_lines(F.split("body", "\n", -1))
        rows = computed_once(rows, judged=F.transform(seen, lambda x: F.struct(x["line"].alias("line"), F.coalesce(fails(x), F.lit(False)).alias("fails"))))
        removed = F.filter("judged", lambda x: x["fails"])["line"]
    rows = rows.select(
        *[c for c in rows.columns if c not in ("lines", "body", "judged")], F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        removed.alias("removed"), *([F.col("body"), F.col("judged")] if cleaned else []),
    )
    rows = computed_once(
        rows, n_lines_removed=F.size("removed").cast("long"),
        n_words_lost=F.when(F.size("removed") == 0, F.lit(0)).otherwise(
            F.regexp_count(F.array_join("removed", "\n"), F.lit(f"[^{SPACE}]+"))).cast("long"),
    )
    if cleaned:
        left = F.array_join(F.filter("judged", lambda x: ~x["fails"])["line"], "\n")
        rows = rows.withColumn("cleaned", F.when(F.size("removed") == 0, F.col("body")).otherwise(left)).drop("body", "judged")
    rows = rows.drop("removed")
    rows = _with_repeats(rows).drop("words")
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeat_percent)
    rejected = F.col("n_words_lost") * 100 > F.col("n_words") * most_lost_percent
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~rejected)
