"""Positive-unlabelled quality: risk and prior on drawn samples, held-out accuracy on the given tables, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtable.llm import pu_quality as q

SF = "/root/testdata/sf0.1"  # 4,000 labels; a tenth of them fixes the prior only within a tenth or so


def drawn(prior, n=3000, seed=1):
    r = np.random.default_rng(seed)
    good, bad = (lambda k: r.normal(1, 1, (k, 4)).astype(np.float32)), (lambda k: r.normal(-1, 1, (k, 4)).astype(np.float32))
    k = int(prior * n)
    return good(n), np.vstack([good(k), bad(n - k)]), k


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.85])
def test_prior_and_risk(prior):
    p, u, k = drawn(prior)
    w = q.against(p[::2], u[::2])
    found = q.class_prior(p[1::2] @ w[:-1], u[1::2] @ w[:-1])
    assert abs(found - prior) < 0.1
    w = q.minimise(p, u, found)
    score = q._sigmoid(u @ w[:-1] + w[-1])
    truth = np.arange(len(u)) < k
    assert ((score > 0.5) == truth).mean() > 0.93
    assert abs(score.mean() - prior) < 0.12  # outputs are probabilities
    assert sum(q.risk(p @ w[:-1] + w[-1], u @ w[:-1] + w[-1], found)) < sum(q.risk(np.zeros(len(p)), np.zeros(len(u)), found))


def test_negative_risk_turns_the_gradient():
    """Where R_u(-) is under prior * R_p(-), a step of the minimiser makes the bracket larger, not smaller."""
    p, u, _ = drawn(0.5, 200)
    w = q.minimise(p, u, 0.97, steps=300)
    assert q.risk(p @ w[:-1] + w[-1], u @ w[:-1] + w[-1], 0.97)[1] > -0.05


def test_features_survive_pieces(monkeypatch):
    r = np.random.default_rng(2)
    text = " ".join("".join(r.choice(list("abcÄé#1"), 5)) for _ in range(400)).encode()
    whole = q._counted(text)
    monkeypatch.setattr(q, "PIECE", 37)
    for a, b in zip(q._counted(text), whole, strict=True):
        assert a.tolist() == b.tolist()
    assert q._figures(text)[:2].tolist() == [400, sum(map(len, text.split()))]
    assert whole[0].sum() == len(text) - 1 and whole[1].sum() == len(text) - 2


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = q.quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    assert rows.held_out.tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]
    held = rows[rows.held_out]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.995
    assert (held.predicted == held.quality).mean() > 0.98
    assert (held.predicted == (held.score >= q.THRESHOLD)).all()
    again = q.quality_scores(docs.repartition(5), labels.repartition(3)).select("doc_id", F.col("score").alias("again")).toPandas()
    both = rows.merge(again, on="doc_id")
    assert len(both) == len(rows) and (both.score - both.again).abs().max() < 1e-6


def test_labels_of_zero_and_of_the_held_out_fold_teach_nothing(spark):
    labels = spark.createDataFrame([(i, q_) for i in range(40) for q_ in ((1,) if i % 3 else (1, 0))] + [(None, 1)], "doc_id long, quality int")
    assert sorted(x[0] for x in q.trusted(labels).collect()) == [i for i in range(40) if i % 3 and zlib.crc32(str(i).encode()) % 4 != 2]


def test_odd_rows(spark):
    schema = "doc_id long, text string, score double, good boolean, other string, x string"
    rows = [(i, f"Plain words number {i} in a line. And so on.", 0.1, True, "o", "x") for i in range(30)] + [(1, "Plain words number 1 in a line. And so on.", 0.1, True, "o", "x"), (None, "no id", 0.0, None, None, None), (77, None, 0.0, None, None, None), (78, "", 0.0, None, None, None), (79, "x" * 3_000_000, 0.0, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, text int")
    out = q.quality_scores(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= x["score"] <= 1 for x in got)
    by = {x["doc_id"]: x for x in got}
    assert by[77]["score"] == by[78]["score"] and not by[None]["held_out"]
    none = q.quality_scores(docs, labels.filter("false")).collect()
    assert {(x["score"], x["predicted"]) for x in none} == {(0.5, 0)}
    assert q.quality_scores(docs.filter("false"), labels).count() == 0
    assert out.filter(F.col("score").isNull()).count() == 0
