"""Queries without SQL against independent Python, row by row."""

import difflib
import math
import re
from collections import Counter

import pytest

from corpusloom import fixtures as X
from corpusloom.queries import queries

SF = "/root/testdata/sf0.001"


def rows(spark, name):
    return queries()[name](spark, SF).collect()


def test_seq_ratio(spark):
    want = {i: None if a is None or b is None else round(difflib.SequenceMatcher(None, a, b).ratio(), 6) for i, a, b in X.PAIRS.rows}
    assert {r.id: r.ratio for r in rows(spark, "seq_ratio")} == want


def slow_chrf(hypothesis, reference):
    h, r = re.sub(r"\s", "", hypothesis), re.sub(r"\s", "", reference)
    precisions, recalls = [], []
    for n in range(1, 7):
        a, b = ([t[i : i + n] for i in range(len(t) - n + 1)] for t in (h, r))
        if a and b:
            common = sum(min(c, b.count(g)) for g, c in Counter(a).items())
            precisions.append(common / len(a))
            recalls.append(common / len(b))
    if not precisions or not sum(precisions) + sum(recalls):
        return 0.0
    p, q = sum(precisions) / len(precisions), sum(recalls) / len(recalls)
    return 100 * 5 * p * q / (4 * p + q)


def test_chrf_and_departure(spark):
    for r in rows(spark, "chrf_sentence"):
        _, ru, en = next(x for x in X.PAIRS.rows if x[0] == r.id)
        assert r.score == pytest.approx(slow_chrf(en or "", ru or ""), abs=1e-3)
        x, y = (re.findall(r"[\w']+", (t or "").lower()) for t in (ru, en))
        blocks = difflib.SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()
        gaps, at = [], 0
        for b in blocks:
            gaps.append(b.b - at)
            at = b.b + b.size
        assert r.span == max(gaps) and r.novelty == pytest.approx(sum(gaps) / max(1, len(y)), abs=1e-6)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_word_errors_by_conversation(spark):
    turns = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    words = {k: [w.strip("-") for w in re.sub(r"[^\w\s-]", " ", t.lower().replace("ё", "е")).split() if w.strip("-")] for k, t in turns.items()}
    want = {}
    for (c, t), w in words.items():
        if (c, t + 1) in words:
            errors, n = want.get(c, (0, 0))
            want[c] = errors + distance(w, words[c, t + 1]), n + len(w)
    got = {r.conv_id: (r.errors, r.words, r.rate) for r in rows(spark, "word_error_by_conversation")}
    assert got == {c: (e, n, pytest.approx(e / n)) for c, (e, n) in want.items()}


def test_rekeyed_rows(spark):
    got = {r.id: (r.source_text, r.echoed) for r in rows(spark, "rekey_to_seeds")}
    assert got == {1: ("I’m ready – let’s go", "I'm ready - let's go"), 2: ("день рождения сегодня вечером", "ден рождения сегодня вечером"), 3: ("совсем другая строка", None), 4: ("ничего общего", None), 5: (None, None)}


def test_entities(spark):
    got = {r.id: r.found for r in rows(spark, "entity_candidates")}
    assert got[8] == ["a.b@c.org", "www.site.org/x", "(+1 555) 010-0199"]
    assert all(not v for k, v in got.items() if k != 8)


KEYS = {c: (float(x), float(y)) for y, row in enumerate(("qwertyuiop", "asdfghjkl", "zxcvbnm")) for x, c in enumerate(row)}


def path(word):
    return [KEYS[c] for c in word.replace("é", "e")]


def length(points):
    return sum(math.dist(p, q) for p, q in zip(points, points[1:], strict=False))


def test_ideal_paths(spark):
    got = {r.word: (r.length, r.n) for r in rows(spark, "gesture_ideal_paths")}
    assert got == {w: (pytest.approx(length(path(w)), abs=1e-6), len(w)) for w in ("hello", "help", "jello", "héllo", "zoo")}


def along(points, n):
    """Points at equal distances along a path."""
    total, out = length(points), []
    for k in range(n):
        left = total * k / (n - 1)
        for p, q in zip(points, points[1:], strict=False):
            step = math.dist(p, q)
            if left <= step + 1e-12 and step:
                out.append((p[0] + (q[0] - p[0]) * left / step, p[1] + (q[1] - p[1]) * left / step))
                break
            left -= step
        else:
            out.append(points[-1])
    return out


def boxed(points):
    xs, ys = zip(*points, strict=True)
    side = max(max(xs) - min(xs), max(ys) - min(ys), 1e-5)
    return [((x - (max(xs) + min(xs)) / 2) / side, (y - (max(ys) + min(ys)) / 2) / side) for x, y in points]


def test_best_words_of_a_gesture(spark):
    drawn = along(path("hello"), 32)
    density = lambda v, d: math.exp(-((v / d) ** 2) / 2) / (d * math.sqrt(2 * math.pi))
    cost = {}
    for w, freq in (("hello", 200), ("help", 120), ("jello", 20), ("héllo", 10), ("zoo", 90)):
        if w[0] in "hjg" and w[-1] in "opi" and abs(length(path(w)) - 12) < 8.42:
            p = along(path(w), 32)
            shape = sum(map(math.dist, boxed(p), boxed(drawn))) / 32
            place = sum(abs(a[0] - b[0]) + abs(a[1] - b[1]) for a, b in zip(p, drawn, strict=True)) / 32
            cost[w] = -math.log(max(density(shape, 0.3) * density(place, 0.5109) * freq, 1e-300))
    want = sorted(cost.items(), key=lambda x: (x[1], x[0]))[:3]
    assert [(r.word, r.cost) for r in rows(spark, "gesture_best_words")] == [(w, pytest.approx(c, abs=1e-4)) for w, c in want]


def test_aligned_tracks(spark):
    got = rows(spark, "monotonic_align")
    for film in ("f", "g"):
        cues = sorted((s, t) for f, s, _, t in X.CUES.rows if f == film)
        steps = [r for r in sorted(got, key=lambda r: r.step) if r.video == film]
        assert [t for r in steps for t in r.left_text.split(" ") if t] == [t for _, t in cues]
        assert [t for r in steps for t in r.right_text.split(" ") if t] == [t.upper() for _, t in cues if t != "blip"]
        assert all(r.score == 1.0 for r in steps if r.kind == "1:1")
    assert [(r.kind, r.left_text) for r in got if r.kind not in ("1:1",)] == [("left_only", "blip")]


def test_clips_of_the_pipeline(spark):
    """No clip holds a moment in which two speak, none is longer than the bound, and short or silent ones say why."""
    spoken = [(f, p, s, e) for f, p, s, e in X.SEGMENTS.rows]
    for c in rows(spark, "clip_pipeline"):
        assert c.end - c.start <= 3.0 + 1e-9
        assert not any(f == c.film and p != c.speaker and min(e, c.end) - max(s, c.start) > 1e-9 for f, p, s, e in spoken)
        cued = [t for f, s, e, t in X.CUES.rows if f == c.film and min(e, c.end) - max(s, c.start) >= 0.5 * (e - s) and e > c.start and s < c.end]
        assert c.text == (" ".join(cued) or None)
        assert c.reason == ("short" if c.end - c.start < 0.6 else "no_text" if not cued else None)
