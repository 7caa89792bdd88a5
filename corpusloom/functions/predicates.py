"""Row predicates and ordered cascades of reject reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L
from corpusloom.functions import text as T

CYRILLIC, LATIN = "[А-Яа-яЁё]", "[A-Za-z]"


def cascade(*reasons: tuple[str, Column]) -> Column:
    """The first reason whose condition holds; null if none does. A condition that is null does not hold."""
    return F.coalesce(*[F.when(condition, F.lit(reason)) for reason, condition in reasons])


def problems(*reasons: tuple[str, Column]) -> Column:
    """All reasons whose conditions hold, in order."""
    return F.filter(F.array(*[F.when(condition, F.lit(reason)) for reason, condition in reasons]), lambda x: x.isNotNull())


def blank(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), T.SPACE, " ")) == ""


def schema_problems(source_lang: Column, source_text: Column, translation: Column, has_subtext: Column, category: Column, note: Column) -> Column:
    """Missing fields, values outside their lists, and a note that contradicts the flag."""
    fields = {"source_lang": source_lang, "source_text": source_text, "translation": translation, "has_subtext": has_subtext, "category": category, "nuance_note": note}
    return problems(
        *[(f"missing {name}", c.isNull()) for name, c in fields.items()],
        ("source_lang not allowed", ~F.coalesce(source_lang.isin(L.LANGUAGES), F.lit(False))),
        ("category not allowed", ~F.coalesce(category.isin(L.CATEGORIES), F.lit(False))),
        ("note without subtext", ~has_subtext & ~blank(note)),
        ("subtext without note", has_subtext & blank(note)),
    )


def language_mismatch(lang: Column, text: Column) -> Column:
    """Tagged Russian without a Cyrillic character, or English with one."""
    cyrillic = text.rlike(r"[\x{0400}-\x{04FF}]")
    return ((lang == "ru") & ~cyrillic) | ((lang == "en") & cyrillic)


def note_too_long(note: Column, most: int = 25) -> Column:
    return T.space_word_count(F.coalesce(note, F.lit(""))) > most


def echoed(source: Column, translation: Column) -> Column:
    """The translation repeats the source."""
    a, b = F.lower(F.trim(F.coalesce(source, F.lit("")))), F.lower(F.trim(F.coalesce(translation, F.lit(""))))
    return (a != "") & (a == b)


def masked_in_row(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike("(?U)" + L.CHECK_MASK)


def masked_in_reply(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike("(?iuU)" + L.EVALUATION_MASK)


def several_speakers(raw: Column) -> Column:
    return F.regexp_count(raw, F.lit(r"(?U)(^|\n|\s)[-–—]\s*\S")) >= 2


def latin_share(text: Column) -> Column:
    latin, cyrillic = F.regexp_count(text, F.lit(LATIN)), F.regexp_count(text, F.lit(CYRILLIC))
    return latin / F.greatest(F.lit(1), latin + cyrillic)


def garbled(ru: Column, en: Column) -> Column:
    """Letters outside the alphabets of the two languages."""
    return ru.rlike(r"(?U)[^\W\d_А-Яа-яЁёA-Za-z]") | en.rlike(r"(?U)[^\W\d_A-Za-zÀ-ÖØ-öø-ÿ]")


def interjection_only(text: Column) -> Column:
    """No content word, or a single token over and over."""
    tokens = F.filter(F.split(T.plain_yo(text), r"(?U)[\W_]+"), lambda t: (t != "") & ~t.rlike(r"^(?U)\d+$"))
    content = F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.isin(L.INTERJECTIONS))
    return (F.size(content) == 0) | (F.size(F.array_distinct(tokens)) < 2)


def credits_line(text: Column) -> Column:
    return text.rlike("(?iuU)" + L.CREDITS)


def pair_reason(ru: Column, en: Column, min_words: int = 3, max_words: int = 25, max_ratio: float = 2.5) -> Column:
    """Why a pair of subtitle lines is rejected; null if it passes."""
    a, b = T.word_count(ru), T.word_count(en)
    between = lambda n: (n >= min_words) & (n <= max_words)
    return cascade(
        ("empty", (F.coalesce(ru, F.lit("")) == "") | (F.coalesce(en, F.lit("")) == "")),
        ("ru_script", ~ru.rlike(CYRILLIC) | (latin_share(ru) > 0.3)),
        ("en_script", en.rlike(CYRILLIC) | ~en.rlike(LATIN)),
        ("credits", credits_line(ru) | credits_line(en)),
        ("length", ~between(a) | ~between(b)),
        ("mojibake", garbled(ru, en)),
        ("interjection", interjection_only(ru) | interjection_only(en)),
        ("len_ratio", F.greatest(a, b) / F.greatest(F.lit(1), F.least(a, b)) > max_ratio),
        ("identical", T.token_key(ru) == T.token_key(en)),
    )


def usable_seed(text: Column, min_words: int = 4, max_words: int = 20) -> Column:
    """A Russian line fit as a seed. The dictionary check passes: no morphology is installed."""
    line = F.trim(F.coalesce(text, F.lit("")))
    n = T.word_count(line)
    return (n >= min_words) & (n <= max_words) & line.rlike(CYRILLIC) & ~line.rlike(LATIN) & ~interjection_only(line)


def refuses(reply: Column, markers: list[str]) -> Column:
    head = F.left(F.lower(F.trim(F.coalesce(reply, F.lit("")))), F.lit(200))
    return reduce(lambda a, b: a | b, [head.contains(m) for m in markers])


def model_failure(error: Column) -> Column:
    return ~reduce(lambda a, b: a | b, [error.startswith(p) for p in L.NOT_A_FAILURE])


def register_reason(line: Column, lang: Column, want: Column, got: Column, slurs: str | None = None, min_words: int = 4, max_words: int = 18) -> Column:
    """Why a generated line is rejected for a cell of the register grid."""
    n = T.space_word_count(line)
    cyrillic = line.rlike("(?iu)[а-яё]")
    return cascade(
        ("chatter", line.rlike("(?U)" + L.CHATTER)),
        ("length", (n < min_words) | (n > max_words)),
        ("masked", masked_in_reply(line)),
        *([("slur", line.rlike(slurs))] if slurs else []),
        ("language", ((lang == "ru") & ~cyrillic) | ((lang == "en") & cyrillic)),
        ("tier", (want > 0) & (got != want)),
    )


def idiom_reason(line: Column, lang: Column, key: Column, banned: list[str], min_words: int = 4, max_words: int = 20) -> Column:
    """Why a generated line is rejected for an idiom; ``key`` is its pattern."""
    n = T.space_word_count(line)
    low = F.lower(line)
    return cascade(
        ("chatter", line.rlike("(?U)" + L.CHATTER)),
        ("length", (n < min_words) | (n > max_words)),
        ("language", (lang == "ru") != line.rlike("(?iu)[а-яё]")),
        ("no idiom", ~F.regexp_like(T.plain_yo(line), key)),
        *([("benchmark idiom", reduce(lambda a, b: a | b, [low.rlike(p) for p in banned]))] if banned else []),
    )


def mime_matches(concrete: Column, wanted: Column) -> Column:
    """``*/*``, ``type/*`` or the same type."""
    family = F.concat(F.split_part(wanted, F.lit("/"), F.lit(1)), F.lit("/"))
    return F.when(wanted == "*/*", True).when(wanted.rlike(r"^[^/]+/\*$"), concrete.startswith(family)).when(wanted.rlike("^[^/]+/"), concrete == wanted).otherwise(False)


def mime_filter(types: Column, wanted: Column, mode: str) -> Column:
    """Whether all, any or exactly one of ``types`` match."""
    if mode == "all":
        return F.forall(types, lambda t: mime_matches(t, wanted))
    if mode == "any":
        return F.exists(types, lambda t: mime_matches(t, wanted))
    return F.size(F.filter(types, lambda t: mime_matches(t, wanted))) == 1


def fits_memory(available: Column, needed: Column, margin: Column) -> Column:
    return available >= needed + margin
