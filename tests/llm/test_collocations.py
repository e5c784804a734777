"""Collocations against brute force: few numbers, small tiles, rows and pieces, so that every path is taken; nulls, marks, copies and clashing columns."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from voxtable.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, n long, rank long, phrase string, score string"


def brute(rows, least=10, longest=3, top=2000, hides=50):
    f = defaultdict(Counter)
    for text, lang in rows:
        lower = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\n\v\f\r]", lower):
            words = re.findall(r"[^ \t]+", piece)
            for size in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        n = sum(v for k, v in counts.items() if len(k) == 1)
        candidates = {k: v for k, v in counts.items() if len(k) > 1 and v >= least}
        hidden = {k[i : i + m] for k, v in candidates.items() for m in range(2, len(k)) for i in range(len(k) - m + 1) if 100 * v >= hides * counts[k[i : i + m]]}
        scored = []
        for k, a in candidates.items():
            if k not in hidden:
                score, _, l, r = min((1000000 * a * a // (counts[k[:i]] * counts[k[i:]]), i, counts[k[:i]], counts[k[i:]]) for i in range(1, len(k)))
                scored.append((-score, -a, " ".join(k).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def texts(seed):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdé\x1cz") for _ in range(r.randint(1, 4))) for _ in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    phrase = "Seldom  seen\tpair"
    rows = []
    for k in range(90):
        words = r.choices(vocabulary, weights, k=r.randint(1, 60))
        words = [w + r.choice([".", ",", "!", "?!", ":", ";", "\n", "\r\n", "\v"]) if r.random() < 0.1 else w.upper() if r.random() < 0.1 else w for w in words]
        rows.append((" ".join(words) + (f" {phrase} {r.choice(vocabulary)}" if k % 3 == 0 else ""), r.choice(["en", "en", "fr", None, "und"])))
    return [*rows, *[rows[0]] * 12, ("", "en"), (None, "fr"), ("  \t ", "es"), ("x" * 700 + " a a a " * 30, "en"), ("solo", "it")]


def found(spark, rows, **how):
    df = spark.createDataFrame([(i, t, lang, 1, 2, "x", "y") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(map(tuple, c.collocations(df, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_all_paths(spark, monkeypatch):
    for name, value in {"TILE": 4, "PIECE": 64, "ROW": 50, "BATCH": 200}.items():
        monkeypatch.setattr(c, name, value)
    rows = texts(1)
    want = brute(rows)
    assert found(spark, rows, head=60) == want
    assert any(len(x[2].split()) == 3 for x in want) and any(len(x[2].split(" ")) == 2 for x in want)
    assert found(spark, rows, head=0, top=5, hides=80) == brute(rows, top=5, hides=80)


def test_defaults_and_empty(spark):
    rows = texts(2)
    assert found(spark, rows) == brute(rows)
    assert found(spark, [("too few words", "en"), (None, None)]) == []
    assert found(spark, []) == []


def test_exact_beyond_64_bits(spark):
    n = 3 * 10**9
    one = spark.createDataFrame([("en", 0, n), ("en", 1, n + 1)], "lang string, w1 long, n long")
    two = spark.createDataFrame([("en", 0, 1, n - 1)], "lang string, w1 long, w2 long, n long")
    assert c._scored({1: one, 2: two}, 2).first()["score"] == 1000000 * (n - 1) ** 2 // (n * (n + 1))


@pytest.mark.parametrize("size", [1, 3, 7, 50])
def test_pieces_are_cut_between_words(size):
    text = b"Ab c.d\te" + b"f" * 30 + b" g\n\nh,i "
    assert b"".join(c.pieces(text, size)) == text.translate(c._MARKS)
    assert [w for p in c.pieces(text, size) for w in p.split()] == text.translate(c._MARKS).split()


def test_tiles_and_coordinates_count_alike():
    r = np.random.default_rng(1)
    left, right = (r.geometric(0.1, 3000) for _ in range(2))
    met = Counter()
    for a, b, n in c.tiled(left, right, 8):
        met.update(dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)))
    assert met == Counter(zip(left.tolist(), right.tolist(), strict=True))
    (a, b), n = c.coordinates([left, right])
    assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)) == met
