"""The pipeline, stage by stage and as a whole, against a chain of plain restatements, on a table with nulls, repeats, ties, very long and empty texts and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import pytest

import corpus_pipeline

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, held string, hits string"


def odd_documents():
    r = random.Random(21)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(900)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    item = prose(20)
    texts = [prose(r.randint(12, 200)) for _ in range(60)]
    texts += [" ".join(w if r.randrange(60) else "other" for w in t.split()) for t in texts[:25]]  # near copies
    texts += texts[3:9] + [prose(15) + " " + item + " " + prose(40) for _ in range(5)] + [prose(600) + " " + item]
    texts += ["", None, " \n\t", "a b", "### $$$ %%% &&& *** ### $$$ %%% &&& *** ###", "1 2 3 4 5 6 7 8 9 10 11 12", "one two three four five six " * 9, prose(9000), "é " + prose(30)]
    rows = [(i, t, r.choice(["s1", "s2", "s3", None]) if i % 3 else "hot") for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (10, texts[11] + " more", "s1"), (None, texts[12], "s1"), (None, prose(40), None), (None, prose(40), None)]
    return [(i, t, "en", s, len(t or ""), "x", "y", "z", "w") for i, t, s in rows], [(1, item), (2, "unlike all"), (3, None), (None, prose(14))]


def kept_by_rules(text):
    words, t = re.findall(WORD, text or ""), text or ""
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    copies, n = len(lines) - len(set(lines)), len(words)
    base = n >= 10 and 100 * len(covered) <= 20 * n
    letters = sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words)
    stutter = sum(a == b for a, b in zip(words, words[1:]))
    return base and 10 * len(re.findall(r"[#*$%&|<>]", t)) <= n and 2 * n <= sum(map(len, words)) <= 15 * n and not (copies > 3 and 2 * copies > t.count("\n") + 1) and 2 * letters >= n and 4 * stutter <= n


def first_of_groups(rows):
    sets = []
    for r in rows:
        w = re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {()})
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    best = {}
    for r, g in zip(rows, group):
        order = (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest())
        best[g] = min(best.get(g, (order, r)), (order, r), key=lambda x: x[0])
    return [r for _, r in best.values()]


def clean(rows, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = {tuple(q[j : j + min(13, len(q))]) for q in map(split, (t for _, t in items)) if q for j in range(len(q) - min(13, len(q)) + 1)}
    out = []
    for r in rows:
        w, hit = split(r[1]), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
        if not hit or 20 * len(hit) < len(w):
            out.append(r)
    return out


def mixed(rows):
    size = lambda r: len(re.findall(WORD, r[1] or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r)
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight, total, fixed = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        share = {s: (total - sum(fixed.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 2 * sizes[s]]
        fixed |= {s: 2.0 * sizes[s] for s in above} if above else share
        if not above or len(fixed) == len(names):
            break
    out = []
    for s in names:
        key = lambda r: (int(hashlib.md5(f"{'' if r[0] is None else r[0]}:20".encode()).hexdigest()[:15], 16), r[0] or 0, size(r))
        at, budget = 0, round(fixed[s])
        epochs = budget // sizes[s] if sizes[s] else 0
        for r in sorted((r for r in rows if r[3] == s), key=key):
            rest = max(0, min(size(r), budget - epochs * sizes[s] - at))
            at += size(r)
            out += [r] * (epochs + (rest > 0 and 2 * rest >= size(r)))
    return out


def sharded(rows, limit):
    place = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    sizes = Counter()
    for r in rows:
        for d in range(61):
            sizes[(d, place(r[0]) >> (60 - d))] += len((r[1] or "").encode())
    out = Counter()
    for r in rows:
        d = next(d for d in range(61) if sizes[(d, place(r[0]) >> (60 - d))] <= limit or d == 60)
        n = sizes[(d, place(r[0]) >> (60 - d))]
        out[(r[0], len((r[1] or "").encode()), f"{place(r[0]):060b}"[:d], d, n, n > limit)] += 1
    return out


def test_stages_match_a_plain_chain(spark, tmp_path, monkeypatch):
    rows, items = odd_documents()
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    steps = [lambda x: [r for r in x if kept_by_rules(r[1])], first_of_groups, lambda x: clean(x, items), mixed]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-dedup", "decontamination", "mixing", "sharding"]
    docs, want = spark.read.parquet(str(tmp_path / "documents.parquet")), rows
    for (name, stage), plain in zip(corpus_pipeline.STAGES, steps):
        out, want = stage(spark, docs, str(tmp_path)), plain(want)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert Counter(tuple(r) for r in docs.collect()) == Counter(want), name
    assert 20 < len(want) != len(rows)
    columns = ("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "oversize")
    assert Counter(tuple(r[c] for c in columns) for r in corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()) == sharded(want, 1 << 20)
    assert Counter(tuple(r[c] for c in columns) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sharded(want, 1 << 20)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, tmp_path, name, stage):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert stage(spark, spark.createDataFrame([], SCHEMA), str(tmp_path)).count() == 0
