"""Text keys and cleaners as Column builders. Python's Unicode rules hold: ``\\w``, ``\\s`` and case are Unicode-aware."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"(?U)[\w']+"
SPACE = r"(?U)\s+"


def folded(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def plain_yo(text: Column) -> Column:
    """Lower case with the letter io written as ie."""
    return F.translate(F.lower(text), "ё", "е")


def exact_key(text: Column) -> Column:
    """Key of exact duplicates: case, io and white space are folded, punctuation counts."""
    return folded(plain_yo(text))


def token_key(text: Column) -> Column:
    """Key of the word tokens alone; underscores and apostrophes belong to words."""
    return F.array_join(F.regexp_extract_all(plain_yo(text), F.lit(WORD), F.lit(0)), " ")


def register_key(text: Column) -> Column:
    """Lower-case words with any other run of characters as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)[^\w]+", " "))


def echo_key(text: Column) -> Column:
    """Lower-case text without punctuation."""
    return folded(F.regexp_replace(F.lower(text), r"(?U)[^\w\s]", " "))


def plain_quotes(text: Column) -> Column:
    """Trimmed text with curly apostrophes made straight; null is empty."""
    return F.translate(F.trim(F.coalesce(text, F.lit(""))), "’‘", "''")


#: Characters of the typographic fold and their plain forms.
TYPOGRAPHIC, PLAIN = "’‘“”«»–—‑‐", "''\"\"\"\"----"


def typographic_fold(compatible: Column) -> Column:
    """Fold of text that is in compatibility form already: quotes, dashes, ellipsis, white space."""
    return folded(F.replace(F.translate(compatible, TYPOGRAPHIC, PLAIN), F.lit("…"), F.lit("...")))


def subtitle_clean(composed: Column) -> Column:
    """A subtitle line (in composed form) without markup, sound cues, notes and the leading dash."""
    text = F.regexp_replace(composed, r"<[^>]+>|\{[^}]*\}", " ")
    text = F.regexp_replace(text, r"\[[^\]]*\]|\([^)]*\)", " ")
    text = F.regexp_replace(text, "[♪♫#]", " ")
    text = F.regexp_replace(text, r"(?U)^\s*[-–—]\s*", "")
    text = F.replace(text, F.lit("..."), F.lit("…"))
    return F.btrim(F.regexp_replace(text, SPACE, " "), F.lit(" -–—"))


def cue_clean(text: Column) -> Column:
    """A cue without lyrics between notes, sound cues, the leading dash and dashes between words."""
    text = F.regexp_replace(text, "♪[^♪]*♪", " ")
    text = F.regexp_replace(text, r"\([^)]*\)|\[[^\]]*\]", " ")
    text = F.regexp_replace(text, r"(?U)^\s*[—–-]\s*", "")
    return folded(F.regexp_replace(text, r"(?U)\s[—–]\s", " "))


def split_words(text: Column) -> Column:
    """Words between Unicode white space; none for the empty text."""
    return F.filter(F.split(folded(text), " "), lambda w: w != "")


#: Hesitation sounds that a filler-free word error rate leaves out.
FILLERS = ["э", "ээ", "эээ", "э-э", "м", "мм", "ммм", "м-м", "хм", "угу", "ага", "а-а", "аа", "ну-у"]


def speech_words(text: Column, drop_fillers: bool = False) -> Column:
    """Words of speech: inner hyphens stay, outer ones go, fillers on request."""
    words = F.transform(split_words(F.regexp_replace(plain_yo(text), r"(?U)[^\w\s-]", " ")), lambda w: F.btrim(w, F.lit("-")))
    words = F.filter(words, lambda w: w != "")
    return F.filter(words, lambda w: ~w.isin(FILLERS)) if drop_fillers else words


def character_key(text: Column) -> Column:
    """Text for character error rates: lower case, io folded, no punctuation and underscores."""
    return folded(F.regexp_replace(plain_yo(text), r"(?U)[^\w\s]|_", " "))


#: English contractions and what they stand for.
CONTRACTIONS = {
    "i'm": "i am", "it's": "it is", "don't": "do not", "can't": "can not", "won't": "will not", "didn't": "did not", "isn't": "is not", "that's": "that is",
    "there's": "there is", "we're": "we are", "they're": "they are", "you're": "you are", "i've": "i have", "i'll": "i will", "let's": "let us", "doesn't": "does not", "wasn't": "was not",
}


def english_words(text: Column) -> Column:
    """Words of English speech with contractions spelled out."""
    plain = F.regexp_replace(F.translate(F.lower(text), "’-", "' "), r"(?U)[^\w\s']", " ")
    spelled = F.create_map(*[F.lit(x) for pair in CONTRACTIONS.items() for x in pair])
    words = F.transform(split_words(plain), lambda w: F.split(F.btrim(F.coalesce(F.try_element_at(spelled, w), w), F.lit("'")), " "))
    return F.filter(F.flatten(words), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Word tokens, as the token key sees them."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def space_word_count(text: Column) -> Column:
    """Words between white space; 0 for the empty text."""
    return F.size(split_words(text)).cast("bigint")


def html_text(html: Column, most: int = 400) -> Column:
    """The start of a page's text: tags are spaces."""
    return F.left(folded(F.regexp_replace(html, r"<[^>]+>", " ")), F.lit(most))


def film_key(ids_line: Column) -> Column:
    """``year/number`` of the first path of an id line; null if its year is not a number."""
    parts = F.split(F.split_part(ids_line, F.lit("\t"), F.lit(1)), "/")
    return F.when((F.size(parts) >= 3) & F.get(parts, 1).rlike(r"^\d+$"), F.concat_ws("/", F.get(parts, 1), F.get(parts, 2)))


def film_code(key: Column) -> Column:
    """``tt`` and at least seven digits; longer numbers are not cut, other keys give null."""
    number = F.regexp_replace(F.element_at(F.split(key, "/"), -1), r"^0+(?=\d)", "")
    return F.when(number.rlike(r"^\d+$"), F.concat(F.lit("tt"), F.when(F.length(number) < 7, F.lpad(number, 7, "0")).otherwise(number)))


def speaker_segment(text: Column) -> Column:
    """``start end speaker`` text as a struct, rounded to milliseconds; null if it is no segment."""
    parts = F.split(F.trim(text), r"[,\s]+")
    start, end = F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double")
    numbers = F.regexp_extract_all(F.get(parts, 2), F.lit(r"[-+]?\d*\.?\d+"), F.lit(0))
    speaker = F.coalesce(F.try_element_at(numbers, F.lit(-1)).try_cast("double").cast("bigint").cast("string"), F.get(parts, 2))
    made = F.struct(F.round(start, 3).alias("start"), F.round(end, 3).alias("end"), speaker.alias("speaker"))
    return F.when((F.size(parts) >= 3) & (end > start), made)


def model_tier(name: Column) -> Column:
    """Size class in a model file's name; null without one."""
    return F.nullif(F.regexp_extract(name, r"-(small|int4|int8)\.litertlm$", 1), F.lit(""))


def result_kind(name: Column) -> Column:
    return F.when(name.contains("crude_probe"), "probe").when(name.contains("profanity_test"), "prof").otherwise("test")


def model_of_result(name: Column) -> Column:
    return F.split_part(name, F.lit("__"), F.lit(1))


def seconds(timecode: Column) -> Column:
    """``h:mm:ss,mmm`` as seconds."""
    p = F.split(timecode, "[:,.]")
    return p[0].cast("int") * 3600 + p[1].cast("int") * 60 + p[2].cast("int") + F.rpad(p[3], 3, "0").cast("int") / 1000.0


def section(document: Column, heading: str) -> Column:
    """The text of one ``## heading`` section, heading included; null if there is none."""
    at = F.locate(f"## {heading}\n", document)
    rest = F.substring(document, at, F.length(document))
    return F.when(at > 0, F.trim(F.regexp_replace(rest, r"(?s)\n## .*$", "")))


def with_proposal(document: Column, title: Column, rule: Column, examples: Column) -> Column:
    """A document with a proposed rule put before its first placeholder ``(none yet)``, or at its end; ``examples``: array of texts."""
    entry = F.concat(F.lit("### Proposed: "), title, F.lit("\n\n"), rule, F.lit("\n\nExamples: "), F.array_join(examples, "; "))
    at = F.locate("(none yet)", document)
    inside = F.concat(F.substring(document, F.lit(1), at - 1), F.btrim(entry, F.lit(" \n\t")), F.lit("\n\n"), F.substring(document, at, F.length(document)))
    return F.when(at > 0, inside).otherwise(F.concat(F.rtrim(document, F.lit("\n")), F.lit("\n\n"), entry, F.lit("\n")))


def template(pattern: str, **values: Column) -> Column:
    """``{name}`` slots filled with columns."""
    out = F.lit(pattern)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def spec_map(spec: Column, pair: str = ",", key: str = ":") -> Column:
    """``a:1,b:2`` as a map of integers."""
    clean = F.filter(F.transform(F.split(spec, pair), F.trim), lambda x: x != "")
    return F.map_from_entries(F.transform(clean, lambda x: F.struct(F.trim(F.split_part(x, F.lit(key), F.lit(1))), F.trim(F.split_part(x, F.lit(key), F.lit(2))).cast("int"))))


def token_distance(a: Column | str, b: Column | str) -> Column:
    """Edit distance of two arrays of words; null counts as empty.

    The distinct words of a row are numbered, and a word becomes the character with its number, so the built-in
    distance of strings does the work. A row with more than some 60,000 distinct words is an error.
    """
    a, b = (F.coalesce(F.col(x) if isinstance(x, str) else x, F.array().cast("array<string>")) for x in (a, b))

    def of(words: Column) -> Column:
        number = F.when(F.size(words) < 0xF000, F.lit(1)).otherwise(F.raise_error(F.lit("too many distinct words in a row")).cast("int"))
        place = lambda w: F.array_position(words, w).cast("int") * number
        code = lambda n: F.when(n < 0xD800, n).otherwise(n + 0x800)
        spelled = lambda text: F.decode(F.unhex(F.array_join(F.transform(text, lambda w: F.lpad(F.hex(code(place(w))), 4, "0")), "")), "UTF-16BE")
        return F.levenshtein(spelled(a), spelled(b))

    return F.element_at(F.transform(F.array(F.array_distinct(F.concat(a, b))), of), 1)
