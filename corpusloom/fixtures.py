"""Small inline inputs: the same rows as a frame and as SQL values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Inline:
    """Rows with a schema; ``sql`` gives them as a derived table for the other engine."""

    schema: str
    rows: tuple

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), self.schema)

    @property
    def names(self) -> list[str]:
        return [c.split()[0] for c in self.schema.split(",")]

    def sql(self, alias: str = "t") -> str:
        def one(v):
            if v is None:
                return "NULL"
            if isinstance(v, bool):
                return str(v).upper()
            if isinstance(v, str):
                return "'" + v.replace("'", "''") + "'"
            if isinstance(v, float):
                return f"{v!r}::DOUBLE"
            return str(v)

        rows = ", ".join("(" + ", ".join(map(one, r)) + ")" for r in self.rows)
        return f"(VALUES {rows}) {alias}({', '.join(self.names)})"


LINES = Inline(
    "id int, text string",
    (
        (1, "Ну и Ёлки-палки!  Что ты делаешь?"), (2, "What the hell, you damn fool"), (3, "- Привет.\n- Пока."), (4, "Вы знаете, мне как-то неудобно, обидно."), (5, "<i>Да, да</i> [music] ♪ ла ♪ ..."), (6, "О, о-о-о."), (7, ""),
        (8, "f*** this, C# and *emph*"), (9, "Тоска такая, что кошки скребут на душе"), (10, "Ты и Вы, твой ваш"), (11, "(sighs) — well... it's FINE"), (12, "тосканский повар"), (13, None), (14, "I'm sorry, but I can't do that"), (15, "блин, чёрт, это фигура"),
        (16, "сукин сын и задница"), (17, "bloody pissed off ass"), (18, "Как об стенку горох, а воз и ныне там"), (19, "Не-не-не!"), (20, "the the THE"), (21, "a_b 'c' d’e — é"),
    ),
)

PAIRS = Inline(
    "id int, ru string, en string",
    (
        (1, "Ну ты и даёшь, приятель!", "Wow, you are unbelievable, man!"), (2, "", "x"), (3, "Only latin words here", "Only latin words here"), (4, "Это просто хорошо сказано", "Это не английский"), (5, "Перевод: Иван Иванов и друзья", "Translated by John Smith"), (6, "Да ну", "Oh no"),
        (7, "Ѓде моя старая шапка, скажи?", "Where is my old hat, tell me?"), (8, "О, ох, ах, ай", "Oh, ah, ooh, hey"), (9, "Он ушёл вчера вечером домой один", "He left home alone yesterday evening and then he never came back to see us again, my friend"), (10, "Рынок открыт 7 марта, заходите", "The señor opens his market on March 7, come in"), (11, "Мне нужен iPhone прямо сейчас", "I need an iPhone right now"),
        (12, None, "null side of it"),
    ),
)

CANDIDATES = Inline(
    "line int, source_lang string, source_text string, translation string, has_subtext boolean, category string, nuance_note string, model string",
    (
        (1, "ru", "Ну ты даёшь", "You are something", True, "idiom", "praise or reproach", "a"), (2, "ru", "Ну ты даёшь", "Well you give", True, "idiom", "literal", "b"), (3, "ru", "Ну ты даёшь", "Wow", False, "none", "", "c"), (4, "en", "Break a leg", "Ни пуха", True, "idiom", "luck", "a"), (5, "en", "Break a leg", "Break a leg", False, "none", "", "b"),
        (6, "en", "Hello", "Привет", False, "none", "oops", "a"), (7, "fr", "Salut", "Hi", False, "none", "", "a"), (8, "ru", "No cyrillic", "x", False, "none", "", "a"), (9, "ru", "Ну ты даёшь", "again", True, "idiom", "dup", "a"), (10, "en", "Damn it", "Ч***т", True, "sarcasm", "", "c"),
        (11, "en", "Nice", " ", False, "none", "", "b"), (12, "en", None, "x", None, "mood", None, "b"), (13, "en", "Long note", "Длинно", True, "sarcasm", "w w w w w w w w w w w w w w w w w w w w w w w w w w", "c"),
    ),
)

REPLIES = Inline(
    "id int, reply string, finish string",
    (
        (1, '{"translation": "Hi", "has_subtext": true, "category": "idiom", "nuance_note": "n"}', "stop"), (2, '```json\n{"translation": "Hi", "has_subtext": "True", "category": "idiom"}\n```', "stop"), (3, '<think>hm {"x": 1}</think> Sure: {"translation": "A", "has_subtext": false, "category": "idiom", "nuance_note": "z"} ok', "stop"), (4, '{"translation": "cut', "length"),
        (5, "I cannot help with that", "stop"), (6, "no json here", "stop"), (7, "", "stop"), (8, None, None), (9, '{"translation": 5}', "stop"), (10, '{"translation": "B", "has_subtext": true, "category": "mood", "nuance_note": null}', "stop"), (11, '{"translation": "C", "has_subtext": true, "category": "none"}', "stop"), (12, "not {json} at all", "stop"),
        (13, '{"translation": "D", "has_subtext": 1, "category": "sarcasm", "nuance_note": 7}', "stop"),
    ),
)

SEGMENTS = Inline(
    "film string, speaker string, s double, e double",
    (
        ("f", "a", 0.0, 2.0), ("f", "a", 2.3, 5.0), ("f", "b", 4.0, 7.0), ("f", "a", 6.0, 8.0), ("f", "b", 9.0, 9.5), ("g", "a", 0.0, 5.0), ("g", "b", 4.0, 6.0), ("g", "c", 4.5, 5.5), ("g", "b", 10.0, 12.0), ("g", "a", 11.0, 11.5),
    ),
)

CUES = Inline(
    "film string, s double, e double, text string",
    (("f", 0.0, 1.0, "one"), ("f", 1.4, 2.5, "two"), ("f", 5.0, 5.4, "blip"), ("f", 8.0, 10.0, "three"), ("g", 0.0, 8.0, "long"), ("g", 8.2, 16.0, "over"), ("g", 16.1, 17.5, "tail")),
)

WORDS = Inline(
    "word string, freq int, locale string, shortcut string",
    (("hello", 200, "en", None), ("help", 150, "en", "hlp"), ("held", 90, None, None), ("Hallo", 255, "de", None), ("shell", 20, "en", "hel"), ("привет", 180, "ru", None), ("heil", 5, None, "hi")),
)

CLIPS = Inline(
    "id int, kind string, text string, created bigint, pinned boolean, sensitive boolean, mime string",
    (
        (1, "text", "alpha", 1000, False, False, "text/plain"), (2, "text", "beta", 900, True, False, "text/plain,text/html"), (3, "text", "alpha", 700, False, False, "text/plain"), (4, "image", None, 400, False, False, "image/png"), (5, "text", "secret", 990, True, True, "text/plain"), (6, "video", None, 100, False, False, "video/mp4"), (7, "text", "alpha", 650, False, True, "text/plain"),
        (8, "text", "mail a.b@c.org or www.site.org/x. call (+1 555) 010-0199, a.b@c.org", 995, False, False, "text/plain"),
    ),
)

EMOJI = Inline(
    "value string, name string, keywords string",
    (("1", "grinning face", "grin|smile|happy"), ("2", "cat face", "cat|pet"), ("3", "red heart", "love|heart"), ("4", "smiling cat", "cat|smile"), ("5", "wave", "hand|hello"), ("6", "heart suit", "card")),
)

CODES = Inline(
    "code string, word string, pos int",
    (("ab", "x", 1), ("ab", "y", 2), ("abc", "z", 3), ("ba", "w", 4), ("ab", "v", 5), ("b", "u", 6)),
)

IDIOMS = ["как об стенку горох", "воз и ныне там", "ёлки-палки", "сукин сын"]
