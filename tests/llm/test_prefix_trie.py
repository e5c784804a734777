"""The prefix trie against brute force, over many blocks, with copies, nulls, ties, repeats, turnless conversations and clashing columns."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from voxtable.llm import prefix_trie as t

SCHEMA = "conv_id long, turn long, role string, text string, n long, depth long, words string"
COLUMNS = ("conv", "depth", "parent_conv", "n", "children", "leaves", "saved", "ends")


def brute(rows, group=t.GROUP, head=t.HEAD):
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            told[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in told.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % head
        made[c] = tuple(own.get(c - (abs(c) % group) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
    nodes = defaultdict(set)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].add(c)
    kids = defaultdict(list)
    for x in nodes:
        if x:
            kids[x[:-1]].append(x)
    leaves, saved = {}, {}
    for x in sorted(nodes, key=len, reverse=True):
        leaves[x] = sum(leaves[k] for k in kids[x]) if kids[x] else 1
        saved[x] = sum(saved[k] for k in kids[x]) + ((len(nodes[x]) - 1) * len(x[-1][1].split()) if x else 0)
    ends = defaultdict(list)
    for c, turns in made.items():
        ends[turns].append(c)
    digest = lambda x: hashlib.sha256(",".join(map(str, sorted(ends[x]))).encode()).hexdigest() if x in ends else None
    return sorted((min(m), len(x), min(nodes[x[:-1]]) if x else -1, len(m), len(kids[x]), leaves[x], saved[x], digest(x) or "") for x, m in nodes.items())


def conversations(seed, n):
    r = random.Random(seed)
    rows = []
    for c in [*range(n), -5, -20]:
        length = r.choice([1, 1, 2, 3, 4, 5, 9])
        turns = [("user" if k % 2 == 0 else "assistant", f"say {r.randint(0, 1)} {'word ' * (k % 3)}") for k in range(length)]
        if c % 5 == 0:  # a third and more are copies or begin alike
            turns = [("user", "hot one"), ("assistant", "hot two"), *turns[:1]] if c % 2 else [("user", "hot one")]
        rows += [(c, k, role, text) for k, (role, text) in enumerate(turns)]
    rows += [(7, None, None, "first"), (7, 0, "user", None), (7, 0, "user", None), (None, 0, "user", "lost"), (8, 1, "", ""), (n + 13, 0, "user", "own"), (n + 16, 0, "user", "own")]
    return rows


@pytest.fixture
def many_blocks(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield spark
    for k, v in was.items():
        spark.conf.set(k, v)


def found(spark, rows, **how):
    df = spark.createDataFrame([(*x, 1, 2, "x") for x in rows], SCHEMA).repartition(3)
    out = t.trie(t.rebuilt(df, **how)).select(*COLUMNS).collect()
    return sorted((x[0], x[1], -1 if x[2] is None else x[2], *x[3:7], x[7] or "") for x in out)


def test_trie_over_blocks(many_blocks, monkeypatch):
    monkeypatch.setattr(t, "PACK", 3)  # long runs are packed
    rows = conversations(1, 160)
    assert found(many_blocks, rows) == brute(rows)


def test_trie_of_one_block_and_of_few(spark):
    rows = conversations(2, 30)
    assert found(spark, rows) == brute(rows)
    one = [(3, 0, "user", "a b c")]
    assert found(spark, one) == brute(one)
    alike = [(c, k, "user", f"turn {k}") for c in range(0, 200, 20) for k in range(4)]
    assert found(spark, alike) == brute(alike)


def test_long_shared_path_passes_blocks(many_blocks):
    """Prefixes of sixty turns shared by all, open over every block."""
    rows = [(c, k, "user", f"turn {k}") for c in range(0, 600, 20) for k in range(60)] + [(c, 60, "user", f"last {c} of them") for c in range(0, 600, 20)]
    assert found(many_blocks, rows) == brute(rows)


def test_empty_table_has_no_nodes(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []


def test_range_minima_bounds():
    r = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64, 65):
        v = r.integers(0, 5, n)
        table, at, depth = t.RangeMinima(v), r.integers(0, n, 50), r.integers(0, 6, 50)
        assert table.right(at, depth).tolist() == [next((j for j in range(i, n) if v[j] < d), n) for i, d in zip(at, depth, strict=True)]
        assert table.left(at, depth).tolist() == [next((j for j in range(i, -1, -1) if v[j] < d), -1) for i, d in zip(at, depth, strict=True)]
        end = np.minimum(at + 1 + r.integers(0, n, 50), n)
        assert table.least(at, end).tolist() == [v[a:b].min() for a, b in zip(at, end, strict=True)]
