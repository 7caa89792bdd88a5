"""Word lists and patterns that decide results. They are data; the rules that use them are elsewhere."""

#: Stems of mild, medium and strong language; the strongest class that matches counts.
RU_PREFIXES = "за|на|от|отъ|вы|у|по|при|до|об|съ|разъ|пере|недо|о|под|подъ|про"
RU_TIERS = {
    3: r"ху[йяеёи]|аху[еий]|пизд|бля|еб[аалуиё]|ёб|ёп(?:т|ать)?\b|сук[аи]\b|сукин|сучк|муда[кч]|мудил|долбо[её]б|залуп|г[ао]ндон|пид[оа]р|шлюх|збс\b",
    2: r"хрен|хер|жоп|хитрожоп|задниц|говн|дерьм|сволоч|ублюд|мраз|сра[тлнч]|дроч|трах|пох\b|грёб|греба|долба",
    1: r"блин\b|ч[её]рт(?:а|у|ов|и|ям)?\b|ч[её]ртов|фиг(?!ур)|капец|ёлки",
}
EN_TIERS = {
    3: r"(?:mother)?fuck|(?:bull)?shit|cunt|asshole|dickhead|cocksuck|bitch|twat",
    2: r"(?:dumb|jack|bad|smart|lard|kick|half)?-?ass(?:es|ed)?\b|arse|bastard|dick\b|prick|piss(?!ed off)|bloody|bollocks|goddamn|douche|wank|screw (?:you|off)",
    1: r"damn|dammit|crap|pissed off|hell\b|heck\b|freaking|frigging|friggin\b|screw (?:it|this|that)",
}
RU_CRUDE = (
    r"ху[йяеёи]|аху[еий]|пизд|бля|еб[аалуиё]|ёб|сук[аи]\b|сукин|сучк|муда[кч]|мудил|залуп|дроч|жоп|говн|сра[тлч]|г[ао]ндон|пид[оа]р|шлюх|хрен|хер|трах|"
    r"сволоч|ублюд|мраз|задниц|сиськ|дерьм|грёб|греба|блин\b"
)
EN_CRUDE = (
    r"fuck|shit|bitch|cunt|dick(?:s|head)?\b|cock\b|pussy|ass(?:es)?\b|asshole|arse|bastard|jerk(?:ing)? off|wank|slut|whore|crap|piss|tits?\b|"
    r"screw (?:you|it|off|this|that)|the hell\b|damn|bollocks|prick|douche|rip you a new one"
)
TIER_NAMES = {1: "mild", 2: "medium", 3: "strong"}

#: Openings of replies that refuse, as the generator and as the evaluation look for them.
GENERATOR_REFUSALS = ["i cannot", "i can't", "i can not", "i won't", "i will not", "i'm unable", "i am unable", "i'm not able", "i am not able", "i must decline", "sorry, but i", "i'm sorry, but", "я не могу", "не могу выполнить"]
EVALUATION_REFUSALS = ["i can't", "i cannot", "i won't", "i'm sorry", "i am sorry", "as an ai", "не могу помочь", "я не могу", "извините, но", "i'm unable", "i am unable"]

#: Masked swearing, as the row checks and as the evaluation look for it.
CHECK_MASK = r"[^\W\d_]\*+[^\W\d_]|[^\W\d_]\*{2,}|\*{2,}[^\W\d_]|[^\W\d_]#+[^\W\d_]"
EVALUATION_MASK = r"\b\w+\*{2,}\w*|\*{2,}\w+|\b[\wа-яё]\*+[\wа-яё]?\b"

#: Stems of emotion words, by name.
EMOTIONS = {
    "obida": r"\bобид\w*",
    "toska": r"\bтоск(?!ан)\w*",
    "nadryv": r"\bнадрыв\w*",
    "shchemit": r"\bщем(ит|ящ|ило)\w*",
    "umilenie": r"\bумил(ени|я|ит|ён|ен)\w*",
    "sovestno": r"\bсовестн\w*",
    "nelovko": r"\bнеловк\w*|\bнеловко\b",
    "zhalko": r"\bжалко\b",
    "dushevno": r"\bдушевн\w*",
    "dusha": r"на душе|душа (болит|ноет|не на месте)|в душе не чаю|отвести душу",
    "toshno": r"\bтошно\b",
    "dosada": r"\bдосад\w*",
    "khandra": r"\bхандр\w*",
    "raskis": r"\bраскис\w*",
    "koshki": r"кошки скребут",
    "ne_po_sebe": r"не по себе",
    "neudobno": r"(как-то|мне|ей|ему|нам) неудобно",
    "stydno": r"\bстыдно\b|\bстыдоб\w*",
}

#: Forms of address: familiar and formal.
FAMILIAR = ["ты", "твой", "тебя", "тебе", "тобой"]
FORMAL = ["вы", "ваш", "вас", "вам", "вами"]

#: Sounds and fillers that carry no meaning by themselves.
INTERJECTIONS = [
    "о", "ох", "ах", "ай", "ой", "эй", "ух", "уф", "ха", "хе", "хи", "хо", "хм", "м", "мм", "ммм", "а", "э", "у", "ну", "ага", "угу", "эх", "фу", "тсс", "бр", "не", "нет", "да", "стоп",
    "oh", "ah", "aah", "ooh", "uh", "um", "hm", "hmm", "mm", "eh", "ha", "heh", "hey", "huh", "wow", "whoa", "no", "yes", "yeah", "stop", "o",
]

#: Subtitle credits and advertisements.
CREDITS = r"(subtitle|субтитр|перевод[а-я]*\s*:|translated by|synced|www\.|http|opensubtitles|addic7ed|downloaded from|релиз|озвуч)"

#: A model's remarks on its own lines.
CHATTER = r"^\s*[*#\-]|\(\d+ words?\)|\d+\s*слов|^\s*\d+[.:)]"

LANGUAGES = ["ru", "en"]
CATEGORIES = ["none", "formality_shift", "idiom", "sarcasm", "emotional_subtext"]

#: Errors that mean "try again later" and are no failure of a model.
NOT_A_FAILURE = ["skipped --", "rate limited --", "network --", "out of credits --"]
