"""Language, register and reply functions as Column builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L
from corpusloom.functions import text as T

PARSED = "struct<translation: string, has_subtext: boolean, category: string, nuance_note: string>"


def _ru(stems: str) -> str:
    return f"(?iuU)(?<![а-яё])(?:{L.RU_PREFIXES})?(?:{stems})"


def _en(stems: str) -> str:
    return rf"(?iuU)\b(?:{stems})"


def tier(text: Column, lang: Column) -> Column:
    """Strongest class of language in the text: 3, 2, 1, or 0 for none."""
    t = F.coalesce(text, F.lit(""))
    of = lambda table, pattern: reduce(lambda c, k: c.when(t.rlike(pattern(table[k])), k), (3, 2, 1), F)
    return F.when(lang == "ru", of(L.RU_TIERS, _ru).otherwise(0)).otherwise(of(L.EN_TIERS, _en).otherwise(0))


def other_language(lang: Column) -> Column:
    return F.when(lang == "ru", "en").otherwise("ru")


def crude(text: Column, lang: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.when(lang == "ru", t.rlike(_ru(L.RU_CRUDE))).otherwise(t.rlike(_en(L.EN_CRUDE)))


def tier_kept(got: Column, wanted: Column) -> Column:
    """Force is kept within one class."""
    return F.abs(got - wanted) <= 1


def address(text: Column) -> Column:
    """``ty``, ``vy``, ``both`` or null, by the tokens of the two forms of address."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit("[А-Яа-яЁё]+"), F.lit(0)), lambda t: F.lower(t))
    has = lambda forms: F.arrays_overlap(tokens, F.lit(forms))
    return F.when(has(L.FAMILIAR) & has(L.FORMAL), "both").when(has(L.FAMILIAR), "ty").when(has(L.FORMAL), "vy")


def emotions(text: Column) -> Column:
    """Names of the emotion words in the text, in the order of the list."""
    low = T.plain_yo(text)
    return F.filter(F.array(*[F.when(low.rlike("(?U)" + p), F.lit(name)) for name, p in L.EMOTIONS.items()]), lambda x: x.isNotNull())


def phrases(text: Column, lexicon: list[str]) -> Column:
    """Phrases of the lexicon that the text contains, in its order."""
    low = T.plain_yo(text)
    return F.filter(F.lit([p.lower().replace("ё", "е") for p in lexicon]), lambda p: F.contains(low, p))


def source_language(text: Column) -> Column:
    """``ru`` if Cyrillic characters are there and no fewer than Latin letters."""
    cyrillic, latin = F.regexp_count(text, F.lit(r"[\x{0400}-\x{04FF}]")), F.regexp_count(text, F.lit("[A-Za-z]"))
    return F.when((cyrillic > 0) & (cyrillic >= latin), "ru").otherwise("en")


def memory_tier(total_bytes: Column) -> Column:
    """Model size for a device's memory; null for too little."""
    return F.when(total_bytes >= 10_500_000_000, "int8").when(total_bytes >= 7_000_000_000, "int4").when(total_bytes >= 5_000_000_000, "small")


def bare_reply(reply: Column) -> Column:
    """A reply without its reasoning block and code fences."""
    text = F.trim(F.regexp_replace(F.coalesce(reply, F.lit("")), r"(?s)<think>.*?</think>", ""))
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?s)^(?:```json|```)", ""), r"```$", ""))


def parse_reply(reply: Column) -> Column:
    """The normalised answer in a reply; null without usable JSON.

    A flag given as text counts if it says true; an unknown category is ``none``; without subtext there is no category.
    """
    body = F.try_parse_json(F.nullif(F.regexp_extract(bare_reply(reply), r"(?s)\{.*\}", 0), F.lit("")))
    get = lambda path, kind: F.try_variant_get(body, path, kind)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(body, path, "variant"))
    given = F.when(get("$.category", "string").isin(L.CATEGORIES), get("$.category", "string")).otherwise("none")
    flag = get("$.has_subtext", "string")
    truth = F.when(kind("$.has_subtext") == "STRING", F.lower(F.trim(flag)) == "true").otherwise(F.coalesce(get("$.has_subtext", "boolean"), F.lit(False)))
    has = truth & (given != "none")
    note = F.when(kind("$.nuance_note").isin("VOID", "BOOLEAN") & ~F.coalesce(get("$.nuance_note", "boolean"), F.lit(False)), "").otherwise(F.coalesce(get("$.nuance_note", "string"), F.lit("")))
    made = F.struct(get("$.translation", "string").alias("translation"), has.alias("has_subtext"), F.when(has, given).otherwise("none").alias("category"), note.alias("nuance_note"))
    return F.when(kind("$.translation") == "STRING", made)


def reply_status(reply: Column, finish: Column) -> Column:
    """``ok``, ``empty``, ``truncated``, ``refused`` or ``no_json``."""
    from corpusloom.functions.predicates import refuses

    text = bare_reply(reply)
    opening = F.locate("{", text)
    closing = F.when(F.contains(text, F.lit("}")), F.length(text) - F.locate("}", F.reverse(text)) + 1).otherwise(0)
    cut = (opening > 0) & ((closing < opening) | (F.coalesce(finish, F.lit("")) == "length"))
    return F.when(text == "", "empty").when(cut, "truncated").when((opening == 0) & refuses(text, L.GENERATOR_REFUSALS), "refused").when((opening == 0) | (closing < opening), "no_json").otherwise("ok")


def user_turn(text: Column, speaker: Column, addressee: Column) -> Column:
    """The message, with the genders that are known on a line of their own."""
    known = lambda name, c: F.when(c.isin("male", "female"), F.concat(F.lit(f"{name}: "), c))
    hints = F.concat_ws(", ", known("speaker", speaker), known("addressee", addressee))
    return F.when(hints == "", text).otherwise(F.concat(text, F.lit("\n("), hints, F.lit(")")))


def answer_json(translation: Column, has_subtext: Column, category: Column, note: Column) -> Column:
    """The answer turn: keys in a fixed order, separators with a space."""
    quoted = lambda c: F.to_json(F.struct(c.alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(c.alias("x")))) - 6)
    has = F.coalesce(has_subtext, F.lit(False))
    parts = {"translation": quoted(translation), "has_subtext": has.cast("string"), "category": quoted(F.when(has, category).otherwise("none")), "nuance_note": quoted(F.when(has, F.coalesce(note, F.lit(""))).otherwise(""))}
    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), v) for k, v in parts.items()]), F.lit("}"))


def chat_turns(system: str, user: Column, assistant: Column | None = None) -> Column:
    """Array of role and content."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("system", F.lit(system)), turn("user", user), *([] if assistant is None else [turn("assistant", assistant)]))


def gender_sentence(speaker: Column, addressee: Column) -> Column:
    """A sentence on the genders that are known; null if none is."""
    person = lambda lead, c: F.when(c == "male", f"{lead} is a man").when(c == "female", f"{lead} is a woman")
    said = F.concat_ws(" and ", person("the speaker", speaker), person("the person addressed", addressee))
    return F.when(said != "", F.concat(F.lit("Context for this sentence: "), said, F.lit(".")))


def first_of(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def contains_weight(text: Column, part: Column) -> Column:
    """Length share of a part that the text contains, case folded; else 0."""
    return F.when(F.contains(F.lower(text), F.lower(part)), F.length(part) / F.length(text)).otherwise(0.0)


def composed(preceding: Column, insert: Column, rules: dict[str, str]) -> Column:
    """Deleted characters and inserted text of the longest rule that the input ends with; case follows its first letter."""
    typed = F.concat(preceding, insert)
    out = F
    for key in sorted(rules, key=len, reverse=True):
        first = F.left(F.right(typed, F.lit(len(key))), F.lit(1))
        value = F.when(F.upper(first) == first, rules[key].upper()).otherwise(rules[key])
        out = out.when(F.lower(typed).endswith(key), F.struct(F.lit(len(key) - 1).alias("delete"), value.alias("insert")))
    return out.otherwise(F.struct(F.lit(0).alias("delete"), insert.alias("insert")))


def row_category(row_category: Column, last_message: Column) -> Column:
    """The category of a row, else that of the JSON in its last message, else ``none``."""
    return F.coalesce(row_category, F.try_variant_get(F.try_parse_json(last_message), "$.category", "string"), F.lit("none"))


def price_per_million(price: Column) -> Column:
    """A price for one token as text for a million; ``?`` if it is no number."""
    number = price.try_cast("double")
    return F.when(number.isNotNull(), F.format_string("$%.2f", number * 1_000_000)).otherwise("?")


def listed_lines(reply: Column) -> Column:
    """Lines of a reply without quotes and list marks; empty ones go."""
    lines = F.transform(F.split(reply, r"\r?\n"), lambda x: F.regexp_replace(F.btrim(F.trim(x), F.lit('"')), r"^[0-9.\- ]+", ""))
    return F.filter(lines, lambda x: x != "")


def candidate_bullets(translation: Column, note: Column) -> Column:
    """One candidate as a line of a prompt."""
    return F.format_string('- translation: "%s" | nuance_note: "%s"', translation, F.coalesce(note, F.lit("")))
