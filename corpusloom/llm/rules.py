"""Quality rules: line-first cleaning, in DataFrame functions only.

Every line of a text is judged by itself, by shares of its own words and characters, so a long line is not lost to one
phrase in it. A line fails

* as navigation, if separators or links make up too many of its words;
* by punctuation, if symbols or doubled exclamation marks are too frequent, if it is in capitals, or if it has several
  words but no sentence ends anywhere in it, or too few for its words;
* as boilerplate, if phrases of page furniture (in four languages) make up too much of it.

Lines that fail are removed. A document is then rejected if its base counts fail or if the cleaning took too much of
its text.

Defined cases: a null text has no words and is rejected as too short; an empty line is kept and counts for nothing;
repeated rows and null ids are judged like any other row; no other column is read. Everything stays in a row, so there
is no shuffle and no group.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD_SPACE, let, words_of


@dataclass(frozen=True)
class Limits:
    """Thresholds of the line and document rules."""

    min_words: int = 50
    #: Percent of words in repeated three-word windows beyond which a document fails.
    max_repeat_percent: int = 50
    #: Percent of a line's word characters that may be symbols, and of its words that may be separators or links.
    max_symbol_percent: int = 10
    max_separator_percent: int = 20
    max_link_percent: int = 30
    #: Percent of a line's words that may end in doubled exclamation or question marks.
    max_shout_percent: int = 30
    #: A line fails in capitals, or without the end of a sentence, from this many words on.
    line_words: int = 4
    #: Words that a line may have for each end of a sentence.
    sentence_words: int = 150
    #: Percent of a line's characters that boilerplate phrases may make up.
    max_boilerplate_percent: int = 25
    #: Percent of the word characters that must be left.
    min_kept_percent: int = 50


#: Phrases of page furniture in lower case.
BOILERPLATE = (
    "accept all cookies", "accept cookies", "add to cart", "all rights reserved", "back to top", "click here", "cookie policy", "enable javascript", "follow us on", "forgot your password", "log in to", "lorem ipsum", "privacy policy",
    "read more", "share this", "sign up for", "skip to content", "subscribe to", "terms and conditions", "terms of service", "terms of use", "we use cookies",
    "alle cookies akzeptieren", "alle rechte vorbehalten", "allgemeine geschäftsbedingungen", "datenschutzerklärung", "hier klicken", "in den warenkorb", "jetzt anmelden", "mehr erfahren", "mehr lesen", "nach oben", "newsletter abonnieren", "passwort vergessen", "weiterlesen", "wir verwenden cookies", "zum inhalt springen",
    "aceptar cookies", "aviso legal", "haga clic aquí", "ir al contenido", "iniciar sesión", "leer más", "política de cookies", "política de privacidad", "suscríbete", "todos los derechos reservados", "términos y condiciones", "utilizamos cookies", "volver arriba", "añadir al carrito",
    "accepter les cookies", "ajouter au panier", "aller au contenu", "cliquez ici", "conditions générales", "en savoir plus", "lire la suite", "mentions légales", "mot de passe oublié", "nous utilisons des cookies", "politique de confidentialité", "retour en haut", "s'abonner à", "tous droits réservés",
)
#: Words that are separators, links, or end in doubled marks, and places where a sentence ends, in words joined by one space with one at both ends.
SEPARATOR = r" [|>»•·/\\-]+(?= )"
LINK = r" (?:https?://|www\.|[^ @]+@)[^ ]+"
SHOUT = r"[!?]{2,}(?= )"
SENTENCE_END = "[.!?:…。！？][\"'’”»)\\]]*(?= )"
SYMBOLS, OTHERS = "[#*$%&|<>]", "[^#*$%&|<>]+"


def alternatives(phrases: list[str]) -> str:
    """A pattern for any of the phrases that tries what they have in common once."""
    by_first: dict[str, list[str]] = {}
    for p in phrases:
        by_first.setdefault(p[:1], []).append(p[1:])
    parts = [re.escape(c) + alternatives(rest) if len(rest) > 1 else re.escape(c + rest[0]) for c, rest in by_first.items() if c]
    return f"(?:{'|'.join(parts)})" + "?" * ("" in by_first) if parts else ""


def repeated_words(words: Column) -> Column:
    """Words that lie in three-word windows found twice or more in their text, the first ones included.

    A window is known by the 64-bit hash of its words. Windows are sorted by hash and position; neighbours with the
    same hash repeat. A window adds as many words as it goes beyond the repeated window before it.
    """
    zero = F.lit(0).cast("bigint")

    def of(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))

        def covered(hashes: Column) -> Column:
            def marked(s: Column) -> Column:
                n = F.size(s)
                hits = F.filter(
                    F.transform(s, lambda x, i: F.when(((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | ((i + 1 < n) & (F.get(s, i + 1)["h"] == x["h"])), x["p"])),
                    lambda p: p.isNotNull(),
                )
                return let(F.array_sort(hits), lambda at: F.aggregate(F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), lambda p, q: F.least(F.lit(3), F.coalesce(q - p, F.lit(3)))), zero, lambda a, x: a + x))

            several = F.size(F.array_distinct(hashes)) < F.size(hashes)
            return F.when(several, let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), marked)).otherwise(zero)

        return F.when(F.size(w) >= 3, let(windows, covered)).otherwise(zero)

    return let(words, of)


def line_fails(line: Column, limits: Limits) -> Column:
    """True for a line with words that is navigation, boilerplate, or not punctuated like prose.

    Cheap tests come first: most lines end like a sentence and have no symbol, mark or link that is worth counting.
    """
    phrases = r"([^\p{L}\p{N}])" + alternatives(list(BOILERPLATE)) + r"(?![\p{L}\p{N}])"

    def of(joined: Column) -> Column:
        chars = F.length(F.replace(joined, F.lit(" "), F.lit("")))
        n = F.length(joined) - chars + 1
        low, padded = F.lower(joined), F.concat(F.lit(" "), joined, F.lit(" "))
        count = lambda pattern: F.regexp_count(padded, F.lit(pattern))
        has = lambda *parts: reduce(lambda a, b: a | b, [joined.contains(p) for p in parts])
        several = n >= limits.line_words
        closed = (n <= limits.sentence_words) & F.right(joined, F.lit(1)).isin(".", "!", "?", "…", ":")
        spoken = F.concat(F.lit(" "), low)
        return (joined != "") & (
            (joined.rlike(SYMBOLS) & (F.length(F.regexp_replace(joined, OTHERS, "")) * 100 > chars * limits.max_symbol_percent))
            | (several & ~closed & ((count(SENTENCE_END) == 0) | (n > count(SENTENCE_END) * limits.sentence_words)))
            | (several & (joined != low) & (joined == F.upper(joined)))
            | (joined.rlike(r"[|>»•·/\\-]") & (count(SEPARATOR) * 100 > n * limits.max_separator_percent))
            | (has("!!", "??", "!?", "?!") & (count(SHOUT) * 100 > n * limits.max_shout_percent))
            | (has("@", "://", "www.") & (count(LINK) * 100 > n * limits.max_link_percent))
            | ((F.length(spoken) - F.length(F.regexp_replace(spoken, phrases, "$1"))) * 100 > F.length(low) * limits.max_boilerplate_percent)
        )

    return let(F.btrim(F.regexp_replace(line, WORD_SPACE, " "), F.lit(" ")), of)


def judge(df: DataFrame, limits: Limits | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Base counts, the cleaned text and the verdict of each document.

    Columns: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``kept``, ``n_lines_removed``, ``kept_chars`` (code points in words of kept lines), ``clean_text``.
    """
    limits = limits or Limits()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
        )

    def lines_of(lines: Column) -> Column:
        return let(
            F.filter(lines, lambda x: x.rlike(r"[^ \t-\r]")),
            lambda full: F.struct(
                (F.size(full) - F.size(F.array_distinct(full))).cast("bigint").alias("n_dup_lines"),
                F.filter(lines, lambda x: ~line_fails(x, limits)).alias("good"),
                F.size(lines).alias("n_lines"),
            ),
        )

    rows = rows.select(
        "id",
        let(words_of(F.col("text")), counts).alias("c"),
        let(F.split(text, "\n"), lines_of).alias("l"),
        F.when(text.rlike(SYMBOLS), F.length(F.regexp_replace(text, OTHERS, ""))).otherwise(0).cast("bigint").alias("n_symbols"),
    )
    good = F.array_join("l.good", "\n")
    rows = rows.select("id", "c.*", "n_symbols", "l.n_dup_lines", (F.col("l.n_lines") - F.size("l.good")).cast("bigint").alias("n_lines_removed"), good.alias("clean_text"), F.length(F.regexp_replace(good, WORD_SPACE, "")).cast("bigint").alias("kept_chars"))
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    whole = F.col("kept_chars") * 100 >= F.col("word_chars") * limits.min_kept_percent
    return rows.select(F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & whole).alias("kept"), "n_lines_removed", "kept_chars", "clean_text")
