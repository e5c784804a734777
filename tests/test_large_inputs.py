"""What changes for long pairs, large lexicons and speakers of many clips: the same results as the plain ways."""

import random
import time

import pytest
from pyspark.sql import functions as F

from voxtable.functions import classes, distance, units
from voxtable.operators import selection, walk, wordjoin


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_bit_distance_equals_the_table():
    r = random.Random(1)
    for _ in range(400):
        letters = "ab" if r.random() < 0.5 else "abcdefgh"
        a, b = ([r.choice(letters) for _ in range(r.choice([0, 1, 2, 5, 30, 70, 130]))] for _ in range(2))
        if r.random() < 0.4:
            b = [x for x in a if r.random() < 0.9]
        assert distance.bit_distance(a, b) == plain(a, b)


def test_ten_thousand_units_in_a_second():
    r = random.Random(2)
    a = [r.choice("abcdefghijklmnop") for _ in range(10_000)]
    b = [x for x in a if r.random() < 0.9]
    began = time.perf_counter()
    found = distance.bit_distance(a, b)
    assert time.perf_counter() - began < 5 and found == 10_000 - len(b)


def test_unit_distance_by_either_way(spark):
    r = random.Random(3)
    rows = [(i, [r.choice(["th", "a", "k͡p", "i"]) for _ in range(r.randint(0, 12))], [r.choice(["th", "a", "k͡p", "i"]) for _ in range(r.randint(0, 12))]) for i in range(60)] + [(60, None, ["a"]), (61, ["a"], None), (62, [], [])]
    frame = spark.createDataFrame(rows, "id int, a array<string>, b array<string>").repartition(3)
    for cells in (0, 20, 1 << 30):
        got = {x["id"]: x["d"] for x in frame.select("id", distance.unit_distance(F.col("a"), F.col("b"), cells).alias("d")).collect()}
        assert got == {i: None if a is None or b is None else plain(a, b) for i, a, b in rows}
    one = frame.filter("id < 60").select(units.edit_distance(F.col("a"), F.col("b")).alias("d"), distance.unit_distance(F.col("a"), F.col("b"), 20).alias("e"))
    assert one.filter("d <> e").count() == 0


def lexicon_case(spark):
    r = random.Random(4)
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}w" for k in range(200)]
    weights = [1 / (k + 1) for k in range(200)]
    texts = [(f"c{i}", " ".join(r.choices(words, weights, k=r.randint(0, 30))), i) for i in range(300)] + [("null", None, 1), ("empty", "", 2), ("odd", "zz qq 'tis aaw aaw", 3)]
    lexicon = [(w, [w.upper(), "1"]) for k, w in enumerate(words) if k % 4] + [("never", ["N"]), ("aaw", ["Z", "Z"]), ("'tis", ["T"])]
    return spark.createDataFrame(texts, "id string, text string, words int").repartition(4), spark.createDataFrame(lexicon, "word string, phones array<string>")


@pytest.mark.parametrize("most,bits", [(0, 1 << 10), (400, 64), (400, 1 << 16), (3000, 1 << 16)])
def test_words_are_found_alike_in_all_ways(spark, most, bits):
    texts, lexicon = lexicon_case(spark)
    told = lambda df: sorted((x["id"], x["phones"], round(x["coverage"], 9)) for x in df.collect())
    want = told(selection.lexicon_lookup(texts, lexicon))
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z']+"), F.lit(0))
    out = wordjoin.looked_up(texts, selection.one_pronunciation(lexicon), words, most=most, bits=bits)
    assert out.columns == ["id", "text", "words", "phones", "coverage"]
    assert told(out) == want
    assert told(selection.lexicon_lookup(texts, lexicon, most=500)) == want


def test_only_rare_words_are_moved(spark):
    texts, lexicon = lexicon_case(spark)
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z']+"), F.lit(0))
    rows, moved, tail = wordjoin.rare_words(texts, selection.one_pronunciation(lexicon), words, "id", 2000, 1 << 16)
    total = rows.select(F.sum(F.size("words"))).first()[0]
    head = {r["word"] for r in tail.collect()}
    assert moved.count() < total / 3 and {r["word"] for r in moved.collect()} <= head
    assert "never" not in head  # the corpus doesn't have it


def walked(rows, cap):
    out, total = [], {}
    for i, speaker, seconds, rank in sorted(rows, key=lambda x: (x[3], x[0])):
        if total.get(speaker, 0.0) + seconds <= cap:
            total[speaker] = total.get(speaker, 0.0) + seconds
            out.append(i)
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_walk_of_large_groups_equals_the_walk_row_by_row(spark, seed):
    r = random.Random(seed)
    rows = [(f"c{i:05d}", r.choice(["hot"] * 6 + ["a", "b", None, ""]), float(r.choice([1, 2, 5, 9, 30, 400, 3000])), r.randint(0, 300)) for i in range(1500)]
    frame = spark.createDataFrame(rows, "id string, speaker string, seconds double, rank int").repartition(5)
    want = walked(rows, 1000.0)
    for most in (40, 10**6):
        got = walk.within_cap(frame, "speaker", "seconds", ["rank", "id"], 1000.0, most)
        assert got.columns == frame.columns and sorted(x["id"] for x in got.collect()) == want
    assert walk.within_cap(frame.limit(0), "speaker", "seconds", ["rank", "id"], 10.0, 1).count() == 0


def test_rows_without_rare_words_are_not_written(spark, monkeypatch):
    """Rows whose words are all known to the tasks stay where they are read; what is written once are those with rare words."""
    texts, lexicon = lexicon_case(spark)
    written = []
    monkeypatch.setattr(wordjoin, "stored", lambda df: written.append(df.localCheckpoint()) or written[-1])
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z']+"), F.lit(0))
    out = wordjoin.looked_up(texts, selection.one_pronunciation(lexicon), words, most=2000, bits=1 << 16)
    assert out.count() == texts.count()
    rows = [df.count() for df in written if "text" in df.columns]
    assert len(rows) == 1 and 0 < rows[0] < 0.8 * texts.count()


def test_phones_of_any_kind_come_back(spark):
    """Phones with nulls, separators or nothing in them, entries without phones, texts without words."""
    texts = spark.createDataFrame([("a", "one two three one"), ("b", "four"), ("c", ""), ("d", "two unknown")], "id string, text string")
    odd = {"one": ["x", None, "\x00"], "two": [], "three": [""], "four": ["", ""]}
    for lexicon in (odd, {k: x for k, x in odd.items() if k != "one"}):
        frame = spark.createDataFrame(list(lexicon.items()), "word string, phones array<string>")
        for most in (1 << 20, 40, 0):
            got = {r["id"]: (r["phones"], round(r["coverage"], 9)) for r in selection.lexicon_lookup(texts, frame, most=most).collect()}
            one = lexicon.get("one", [])
            share = round(1.0 if one else 0.5, 9)
            assert got == {"a": ([*one, "", *one], share), "b": (["", ""], 1.0), "c": ([], 0.0), "d": ([], 0.5)}


def test_collapsed_classes_equal_the_column_functions(spark):
    rows = spark.createDataFrame([(x,) for x in ("p pʰ b a a ou x", "", None, "q q", "t͡ʃ d͡ʒ ŋ n n", "s  s")], "ipa string")
    plain_ = F.array_join(units.collapse(classes.ipa_classes(units.split_units(F.coalesce("ipa", F.lit(""))))), "")
    assert rows.filter(~plain_.eqNullSafe(classes.collapsed_ipa_classes(F.col("ipa")))).count() == 0


def test_agreement_of_a_long_clip(spark):
    """Text and audio of some 4,000 classes each go by the bit vectors."""
    r = random.Random(5)
    words = [r.choice(["ta", "ki", "mo"]) for _ in range(2_000)]
    ipa = " ".join(c for w in words for c in w if r.random() < 0.9)
    frame = spark.createDataFrame([("a", " ".join(words), ipa), ("b", "ta ki", "t a k"), ("c", None, None)], "id string, text string, ipa string")
    lexicon = spark.createDataFrame([(w, [w[0].upper(), "AH1"]) for w in ("ta", "ki", "mo")], "word string, phones array<string>")
    got = {x["id"]: x["uer"] for x in selection.agreement(frame, lexicon).collect()}
    assert 0.05 < got["a"] < 0.2 and got["b"] == 0.25 and got["c"] == 1.0


def test_string_distance_by_either_way(spark):
    r = random.Random(6)
    rows = [(i, "".join(r.choices("abc", k=r.randint(0, 12))), "".join(r.choices("abc", k=r.randint(0, 12)))) for i in range(60)] + [(60, None, "a"), (61, "a", None)]
    frame = spark.createDataFrame(rows, "id int, a string, b string")
    for cells in (0, 20, 1 << 30):
        got = {x["id"]: x["d"] for x in frame.select("id", distance.string_distance(F.col("a"), F.col("b"), cells).alias("d")).collect()}
        assert got == {i: None if a is None or b is None else plain(a, b) for i, a, b in rows}
