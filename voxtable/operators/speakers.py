"""Pseudo-speakers: over-segment embeddings with k-means on Spark, agglomerate the few centroids, carry labels back.

The k-means is reproducible: vectors are whole numbers (unit vectors times SCALE), so distances and sums are exact whatever the order and partitioning; seeds are the different vectors that come first by
a hash of their content; ties go to the first centroid; a centroid that loses all its vectors is gone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.functions.units import l2_normalize
from voxtable.operators.quantiles import number, quantiles
from voxtable.sources.corpus import settled

#: Centroids at most: their pairwise matrix stays under 128 MB on the driver.
CENTROIDS = 4000
#: Whole steps of a unit vector's coordinate; dot products stay far below 2^53.
SCALE = 1 << 15
ITERATIONS = 20
#: Rows whose distances to all centroids are held at once.
_ROWS = 1024


def oversegment(df: DataFrame, k: int = CENTROIDS, seed: int = 0, column: str = "embedding", iterations: int = ITERATIONS) -> tuple[DataFrame, np.ndarray]:
    """df with centroid (number), and the unit-length centroids; k is capped by a quarter of the rows. A centroid's number is its place among the centers sorted by value."""
    whole = F.transform(l2_normalize(F.col(column)), lambda x: F.round(x.cast("double") * SCALE).cast("int"))
    rows = settled(df.withColumn("whole", whole))
    n = rows.count()
    if n < 2:  # nothing to part
        return rows.drop("whole").withColumn("centroid", F.lit(0)), unit(np.array([r[0] for r in rows.select(column).collect()], float).reshape(n, -1 if n else 1))
    k = max(2, min(k, CENTROIDS, n // 4))
    named = F.md5(F.concat(F.array_join("whole", ","), F.lit(f":{seed}" if seed else "")))
    firsts = rows.select(named.alias("name"), "whole").groupBy("name").agg(F.first("whole").alias("whole")).orderBy("name").limit(k)
    centers = np.array([r["whole"] for r in firsts.orderBy("name").collect()], np.int64)  # k vectors
    for _ in range(iterations):
        moved = _moved(rows.select("whole"), centers)
        if np.array_equal(moved, centers):
            break
        centers = moved
    order = np.lexsort(centers.T[::-1])
    centers = centers[order]
    return _assigned(rows, centers).drop("whole"), unit(centers.astype(float))


def nearest(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The first of the nearest centers of each vector; all are whole numbers, so that products in doubles are exact."""
    c = centers.astype(float)
    norms = (c * c).sum(1)
    return np.concatenate([(norms - 2 * (vectors[at : at + _ROWS].astype(float) @ c.T)).argmin(1) for at in range(0, len(vectors), _ROWS)] or [np.zeros(0, int)])


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _moved(rows: DataFrame, centers: np.ndarray) -> np.ndarray:
    """The rounded mean of each center's vectors. A task sends one sum a center that it met; the sums are added up by center."""
    k, size = centers.shape
    sent = rows.sparkSession.sparkContext.broadcast(centers)
    schema = "centroid int, n long, sums array<long>"

    def batch(numbers: np.ndarray, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, size, dtype=np.int32)), pa.array(sums.ravel()))
        return pa.RecordBatch.from_pydict({"centroid": pa.array(numbers.astype(np.int32)), "n": pa.array(n), "sums": lists})

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for b in batches:
            x = _vectors(b.column("whole"), size)
            at = nearest(x, sent.value)
            np.add.at(sums, at, x)
            n += np.bincount(at, minlength=k)
        met = np.flatnonzero(n)
        if len(met):
            yield batch(met, n[met], sums[met])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), {}
        for b in batches:
            for c, m, s in zip(b.column("centroid").to_pylist(), b.column("n").to_pylist(), _vectors(b.column("sums"), size), strict=True):
                n[c] += m
                sums[c] = sums[c] + s if c in sums else s.copy()
        met = np.array(sorted(sums), int)
        if len(met):
            yield batch(met, n[met], np.array([sums[c] for c in met]))

    out = rows.mapInArrow(own, schema).repartition("centroid").mapInArrow(total, schema).orderBy("centroid").toArrow()  # k rows
    n = out.column("n").to_numpy()[:, None]
    sums = out.column("sums").combine_chunks()
    sums = _vectors(sums.chunk(0) if isinstance(sums, pa.ChunkedArray) else sums, size)
    return (2 * sums + n) // (2 * n)


def _assigned(rows: DataFrame, centers: np.ndarray) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(centers)

    @F.arrow_udf("int")
    def number_of(whole: pa.Array) -> pa.Array:
        return pa.array(nearest(_vectors(whole, sent.value.shape[1]), sent.value).astype(np.int32))

    return rows.withColumn("centroid", number_of("whole"))


def unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)


def agglomerate(centroids: np.ndarray, threshold: float = 0.7) -> np.ndarray:
    """Average-linkage clusters of unit vectors, merged while their mean cosine distance is under 1 - threshold.

    Nearest-neighbour chains: average linkage is reducible, so merging mutual neighbours as they come gives the same tree in quadratic time.
    Clusters are numbered by their first centroid.
    """
    n = len(centroids)
    if n == 0:
        return np.zeros(0, int)
    d = 1.0 - centroids @ centroids.T
    np.fill_diagonal(d, np.inf)
    size, alive, members = np.ones(n), np.ones(n, bool), {i: [i] for i in range(n)}
    final: list[list[int]] = []
    chain: list[int] = []
    while members:
        if not chain:
            chain = [min(members)]
        while True:
            here = chain[-1]
            row = np.where(alive, d[here], np.inf)
            near = int(row.argmin())
            if len(chain) > 1 and row[chain[-2]] <= row[near]:
                near = chain[-2]
            if not np.isfinite(row[near]) or row[near] >= 1.0 - threshold:
                # its nearest is too far, and merges elsewhere only move the mean: done with it
                final.append(members.pop(here))
                alive[here] = False
                chain.pop()
                break
            if len(chain) > 1 and near == chain[-2]:
                a, b = chain.pop(), chain.pop()
                a, b = min(a, b), max(a, b)
                d[a] = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
                d[:, a] = d[a]
                d[a, a] = np.inf
                size[a] += size[b]
                alive[b] = False
                members[a] += members.pop(b)
                break
            chain.append(near)
    out = np.empty(n, int)
    for k, group in enumerate(sorted(final, key=min)):
        out[group] = k
    return out


def label_speakers(df: DataFrame, merged: np.ndarray, prefix: str = "spk") -> DataFrame:
    """df (centroid) with speaker_idx and speaker."""
    table = df.sparkSession.createDataFrame([(i, int(m)) for i, m in enumerate(merged)], "centroid int, speaker_idx int")
    return df.join(F.broadcast(table), "centroid").withColumn("speaker", F.format_string(f"{prefix}_%04d", "speaker_idx"))  # CENTROIDS rows at most


def pseudo_speakers(df: DataFrame, k: int = CENTROIDS, threshold: float = 0.7, seed: int = 0, prefix: str = "spk", column: str = "embedding") -> DataFrame:
    """df with centroid, speaker_idx and speaker; an empty table stays empty."""
    rows, centers = oversegment(df, k, seed, column)
    return label_speakers(rows, agglomerate(centers, threshold), prefix)


def cluster_report(speakers: DataFrame) -> DataFrame:
    """Speakers, median (truncated) and largest cluster size, its share, singletons."""
    sizes = settled(speakers.groupBy("speaker").agg(F.count("*").alias("clips")))
    median = quantiles(sizes, {"clips": (F.col("clips"), (0.5,))})["clips", 0.5]
    return sizes.agg(F.count("*").alias("speakers"), F.max("clips").alias("max_clips"), (F.max("clips") / F.sum("clips")).alias("max_share"), F.sum((F.col("clips") == 1).cast("long")).alias("singletons")).select(
        "speakers", number(median).cast("int").alias("median_clips"), "max_clips", "max_share", "singletons"
    )


def top_clusters(speakers: DataFrame, n: int = 5) -> DataFrame:
    return speakers.groupBy("speaker").agg(F.count("*").alias("clips")).orderBy(F.desc("clips"), "speaker").limit(n)


def snr_report(speakers: DataFrame) -> DataFrame:
    found = quantiles(speakers, {"snr": (F.col("snr_est"), (0.05, 0.5, 0.95))})
    return speakers.sparkSession.range(1).select(*(number(found["snr", p]).alias(name) for name, p in (("p5", 0.05), ("median", 0.5), ("p95", 0.95))))
