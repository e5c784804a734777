"""Where heavy rows stay: audio lookup in rounds, file pruning, named outputs, quantiles without sorting, reproducible clustering."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtable.operators import assemble, lookup, quantiles, speakers
from voxtable.sources import corpus, files


@pytest.fixture
def shards(spark, tmp_path):
    """Six shard files of twenty clips."""
    rows = [(f"s{k}_{i:03d}", f"train-{k:05d}.parquet", bytes([k, i]) * 50) for k in range(6) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, file_name string, data binary")
    path = str(tmp_path / "shards")
    files.write_named(df.select("id", F.struct(F.col("data").alias("bytes"), F.col("id").alias("path")).alias("audio"), "file_name"), path, order=("id",))
    return path


def results_of(spark, n=6):
    rows = [(f"s{k}_{i:03d}", f"train-{k:05d}.parquet", i, f"s{k}_{i:03d}", "x" * 40, ["a", "bc"]) for k in range(n) for i in range(20)]
    return spark.createDataFrame(rows, "id string, shard string, row long, audio_path string, ipa string, units array<string>")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(spark, df):
    """Files that the scans of a plan open."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fresh = df.select("*")
        plan = fresh._jdf.queryExecution().executedPlan()
        spark._jvm.org.apache.spark.sql.execution.SparkPlan  # noqa: B018
        plan.executeCollect()
        leaves, total = plan.collectLeaves(), 0
        for k in range(leaves.size()):
            metrics = leaves.apply(k).metrics()
            if metrics.contains("numFiles"):
                total += metrics.apply("numFiles").value()
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


@pytest.mark.parametrize("most", [1 << 20, 6_000, 1_000])
def test_audio_lookup_is_the_join_at_any_size(spark, shards, most):
    source, results = corpus.read_shards(spark, shards, ["audio"]), results_of(spark)
    out = assemble.attach_audio(results, source, most=most)
    assert out.columns == [*results.columns, "audio"]
    got = sorted((r["id"], r["shard"], r["row"], r["audio"]["path"], bytes(r["audio"]["bytes"])) for r in out.collect())
    assert got == [(f"s{k}_{i:03d}", f"train-{k:05d}.parquet", i, f"s{k}_{i:03d}", bytes([k, i]) * 50) for k in range(6) for i in range(20)]


def test_no_exchange_carries_audio_and_a_round_opens_its_own_files(spark, shards):
    source, results = corpus.read_shards(spark, shards, ["audio"]), results_of(spark)
    parts = list(lookup.looked_up(source, results, 6_000))
    assert len(parts) == 3
    for part in parts:
        plan = plan_of(part)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
        assert files_read(spark, part) == 2
    chunks = lookup.rounds(results, 2_000)
    assert all(len(x) == 1 and x[0][2] - x[0][1] < 20 for x in chunks)
    assert sorted((s, r) for ((s, a, b),) in chunks for r in range(a, b) if r < 20) == sorted((f"train-{k:05d}.parquet", r) for k in range(6) for r in range(20))


def test_write_beside(spark, shards, tmp_path):
    path = str(tmp_path / "full")
    lookup.write_beside(corpus.read_shards(spark, shards, ["audio"]), results_of(spark, 5), path, 5_000)
    assert spark.read.parquet(path).count() == 100 and "audio" in spark.read.parquet(path).columns
    lookup.write_beside(corpus.read_shards(spark, shards, ["audio"]), results_of(spark).limit(0), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_selected_clips_go_to_their_audio(spark, shards):
    source = corpus.read_shards(spark, shards)
    chosen = spark.createDataFrame([("s1_003", True, "a"), ("s5_019", True, None), ("s0_000", False, "c"), ("none", True, "d")], "id string, selected boolean, note string")
    for most in (1 << 20, 100):
        out = assemble.join_selected(source, chosen, most)
        assert sorted((r["id"], r["shard"], r["row"], r["note"], r["audio"]["path"]) for r in out.collect()) == [("s1_003", "train-00001.parquet", 3, "a", "s1_003"), ("s5_019", "train-00005.parquet", 19, None, "s5_019")]
    plan = plan_of(assemble.join_sidecar(source, chosen.drop("selected")))
    assert "SortMergeJoin" not in plan and plan.count("Exchange") == plan.count("BroadcastExchange") + plan.count("ReusedExchange")


def test_value_bytes(spark):
    df = spark.createDataFrame([("ab", ["x", "yz"], [1, 2, 3], {"k": "v"}, (1, "q")), (None, None, None, None, None)], "a string, b array<string>, c array<long>, d map<string,string>, e struct<f:int,g:string>")
    assert [r[0] for r in df.select(lookup.row_bytes(df)).collect()] == [48 + 2 + 19 + 24 + 18 + 9, 48 + 8]


def test_pending_shards_are_told_by_name(spark, shards, tmp_path):
    done = str(tmp_path / "done")
    assert len(files.pending_files(spark, shards, done)) == 6
    os.makedirs(f"{done}/shard=train-00001.parquet")
    open(f"{done}/train-00004.parquet", "w").close()
    left = files.read_pending(spark, shards, done)
    assert sorted(os.path.basename(x) for x in left.inputFiles()) == [f"train-{k:05d}.parquet" for k in (0, 2, 3, 5)]
    assert left.count() == 80 and {r[0] for r in left.select("row").distinct().collect()} == set(range(20))
    some = files.read_pending(spark, shards, done, only="0000", limit=2, columns=["id"])
    assert some.columns == ["id", "shard", "row"] and {r["shard"] for r in some.collect()} == {"train-00000.parquet", "train-00002.parquet"}
    for k in (0, 2, 3, 5):
        open(f"{done}/train-{k:05d}.parquet", "w").close()
    none = files.read_pending(spark, shards, done)
    assert none.count() == 0 and none.columns == ["id", "audio", "shard", "row"]


def test_named_files_and_nothing_else(spark, tmp_path):
    rows = spark.createDataFrame([(f"id{i:04d}", "test-0.parquet" if i % 10 == 0 else "train-0.parquet", i) for i in range(1000)], "id string, shard string, n_units int").repartition(7)
    path = str(tmp_path / "sidecar")
    made = corpus.write_sidecar(rows, path, 300)
    want = ["test-00000-of-00001.parquet", *(f"train-{k:05d}-of-00003.parquet" for k in range(3))]
    assert made == want and sorted(x for x in os.listdir(path) if not x.startswith(".")) == want
    back = spark.read.parquet(path)
    assert back.columns == ["id", "shard", "n_units"]
    first = spark.read.parquet(f"{path}/train-00000-of-00003.parquet").collect()
    assert len(first) == 300 and [r["id"] for r in first] == sorted(r["id"] for r in first)
    with pytest.raises(FileExistsError):
        corpus.write_sidecar(rows, path, 300)


def test_commit_goes_on_where_it_stopped_and_ignores_lost_attempts(spark, tmp_path):
    """An attempt that never committed leaves its files aside; a commit that was cut off can be called again."""
    path, staging = str(tmp_path / "out"), str(tmp_path / "out" / "_staging-x")
    df = spark.createDataFrame([("a.parquet", 1), ("b.parquet", 2)], "file_name string, x int")
    df.repartition("file_name").write.partitionBy("file_name").parquet(staging)
    lost = f"{staging}/_temporary/0/_temporary/attempt_1/file_name=a.parquet"
    os.makedirs(lost)
    open(f"{lost}/part-00000-lost.parquet", "w").close()
    part = next(x for x in os.listdir(f"{staging}/file_name=a.parquet") if x.startswith("part-"))
    os.rename(f"{staging}/file_name=a.parquet/{part}", f"{path}/a.parquet")
    assert files.commit_named(spark, staging, path) == ["a.parquet", "b.parquet"]
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1, 2] and not os.path.exists(staging)
    os.makedirs(f"{path}/_staging-y/file_name=c.parquet")
    with pytest.raises(ValueError, match="not committed"):
        files.commit_named(spark, f"{path}/_staging-y", path)


def test_quantiles_are_exact(spark):
    r = random.Random(5)
    columns = {
        "plain": [r.gauss(0, 1) for _ in range(3000)], "ties": [float(r.randint(0, 3)) for _ in range(3000)], "wide": [math.copysign(10 ** r.uniform(-300, 300), r.random() - 0.5) for _ in range(3000)],
        "one": [7.0] * 3000, "few": [None] * 2998 + [1.0, 2.0], "none": [None] * 3000, "odd": [math.nan] * 1500 + [None] * 500 + [float(k) for k in range(1000)],
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(5)
    ps = (0.0, 0.05, 0.37, 0.5, 0.95, 1.0)
    got = quantiles.quantiles(df, {c: (F.col(c), ps) for c in columns}, buckets=16, kept=20)
    for c, values in columns.items():
        held = np.array([v for v in values if v is not None])
        for p in ps:
            want = np.sort(held)[[math.floor(p * (len(held) - 1)), math.ceil(p * (len(held) - 1))]] if len(held) else None
            if want is None:
                assert got[c, p] is None
            elif np.isnan(want).any():
                assert math.isnan(got[c, p])
            else:
                at = p * (len(held) - 1) % 1
                assert got[c, p] == pytest.approx(want[0] + at * (want[1] - want[0]) if at else want[0], rel=1e-12), (c, p)


def test_clusters_do_not_depend_on_partitions_or_order(spark):
    r = np.random.default_rng(4)
    vectors = r.normal(size=(6, 8))[r.integers(0, 6, 240)] + r.normal(scale=0.2, size=(240, 8))
    rows = [(f"c{i:03d}", [float(x) for x in v]) for i, v in enumerate(vectors)] + [("copy1", [1.0] * 8), ("copy2", [1.0] * 8)]
    told = []
    for n in (1, 3, 7):
        r.shuffle(rows)
        out = speakers.pseudo_speakers(spark.createDataFrame([(a, list(b)) for a, b in rows], "id string, embedding array<double>").repartition(n), 12, 0.7)
        told.append(sorted((x["id"], x["centroid"], x["speaker"]) for x in out.collect()))
    assert told[0] == told[1] == told[2]


def test_a_round_reads_its_own_metadata(spark, shards):
    """Metadata lie in the order of their shards, so a round doesn't read those of all."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the case is small
    try:
        thin = lookup.by_shard(results_of(spark).repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    at = thin.select("shard", F.col("_metadata.file_name").alias("file")).distinct().collect()
    of = {s: {r["file"] for r in at if r["shard"] == s} for s in {r["shard"] for r in at}}
    assert len({r["file"] for r in at}) > 1 and all(len(x) <= 2 for x in of.values())
    assert thin.count() == 120 and thin.columns == results_of(spark).columns
