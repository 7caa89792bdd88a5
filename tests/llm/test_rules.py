import re
from collections import Counter

from corpusloom.llm import rules
from tests.llm.util import WORD, frame, odd_texts

DATA = "/root/testdata/sf0.001/documents.parquet"


def base(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_base_counts_against_brute_force(spark):
    texts = odd_texts() + ["a b c a b c a b", "x y z q x y z", "l\nl\n\n \nl\nm"] + [r.text for r in spark.read.parquet(DATA).select("text").collect()]
    rows = rules.judge(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[r.doc_id]), texts[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_verdict_follows_the_lines(spark):
    prose = "\n".join(f"Plain{i} words{i} make{i} up{i} sentence{i} that{i} goes{i} on{i}." for i in range(9))
    nav = "\n".join(f"home {i} | about {i} | contact {i} | help {i}" for i in range(40))
    shout = "\n".join(f"BUY{i}!! NOW{i * 3}!! CHEAP{i * 7}!! THINGS{i}!!" for i in range(40))
    mixed = prose + "\nAll rights reserved.\nhome | about | contact"
    rows = {r.doc_id: r for r in rules.judge(frame(spark, [prose, nav, shout, mixed])).collect()}
    assert [rows[i].kept for i in range(4)] == [True, False, False, True]
    assert rows[3].n_lines_removed == 2 and rows[3].clean_text == prose


def bad_line(line):
    """The rules of a line in plain Python, from their description."""
    words = WORD.findall(line)
    if not words:
        return False
    n, joined = len(words), " ".join(words)
    chars = sum(map(len, words))
    ends = sum(bool(re.search("[.!?:…。！？][\"'’”»)\\]]*$", w)) for w in words)
    if sum(c in "#*$%&|<>" for c in joined) * 100 > 10 * chars:
        return True
    if n >= 4 and (ends == 0 or n > 150 * ends or (joined == joined.upper() != joined.lower())):
        return True
    if 100 * sum(not w.strip("|>»•·/\\-") for w in words) > 20 * n or 100 * sum(w[-1] in "!?" and w[-2:-1] in ("!", "?") for w in words) > 30 * n:
        return True
    if 100 * sum(bool(re.match(r"(https?://|www\.|[^ @]+@).", w)) for w in words) > 30 * n:
        return True
    low, found = joined.lower(), 0
    marks = [False] * len(low)
    for phrase in rules.BOILERPLATE:
        for m in re.finditer(re.escape(phrase), low):
            around = low[m.start() - 1 : m.start()] + low[m.end() : m.end() + 1]
            if not any(c.isalnum() for c in around):
                marks[m.start() : m.end()] = [True] * len(phrase)
    found = sum(marks)
    return 100 * found > 25 * len(low)


def test_verdict_against_plain_python(spark):
    good = "This is a sentence that goes on for a while, and says something new. " * 1
    long_line = " ".join(f"Here comes sentence {i} of a long paragraph{i} with words{i}." for i in range(30))
    shapes = ["Home » Products » Shoes", "www.a.org www.b.org see", "WRITE TO US NOW OR NEVER.", "Heading Words", "A heading of five words", "Read more", "Mehr erfahren über uns", "Política de privacidad.", "Tous droits réservés.", "«Oui, dit-il.»", "tags: a | b | c | d", "mail me@x.org", "No end " * 60, long_line + " You can read more about it in the annex.", good, "it was ok -", "", "  ", "Really?? Yes!! No", "日本語です。 はい。 a b"]
    texts = odd_texts() + shapes + [long_line + "\n" + "\n".join(shapes)] + [r.text for r in spark.read.parquet(DATA).select("text").collect()]
    rows = rules.judge(frame(spark, texts)).collect()
    for r in rows:
        lines = (texts[r.doc_id] or "").split("\n")
        kept = [x for x in lines if not bad_line(x)]
        assert r.clean_text == "\n".join(kept) and r.n_lines_removed == len(lines) - len(kept), texts[r.doc_id][:200]
        chars = sum(len(w) for x in kept for w in WORD.findall(x))
        assert r.kept_chars == chars
        assert r.kept == (not base(texts[r.doc_id])[5] and 2 * chars >= r.word_chars)


def test_one_phrase_does_not_take_a_long_line(spark):
    one_line = " ".join(f"Here{i} comes sentence{i} of a{i} long paragraph{i} with words{i}." for i in range(30))
    rows = rules.judge(frame(spark, [one_line, one_line + " You can read more about it in the annex.", one_line + " and so on without an end", " ".join(f"w{i}" for i in range(240))])).collect()
    assert {r.doc_id: r.kept for r in rows} == {0: True, 1: True, 2: True, 3: False}


def test_clashing_columns_and_empty_table(spark):
    df = frame(spark, ["a b"]).selectExpr("*", "1 as id", "2 as c", "3 as l", "4 as n_words")
    assert rules.judge(df).count() == 1
    assert rules.judge(frame(spark, [])).count() == 0
