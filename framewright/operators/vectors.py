"""Feature vectors: clusters, rankings within them, nearest neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions.numbers import dot


def centrality(df: DataFrame, cluster: str, vector: str = "embedding") -> DataFrame:
    """Column centrality: each row's summed cosine with all rows of its cluster, itself included.

    The sum of cosines with all members is the cosine with their summed unit vectors: no pairs are made.  A zero vector
    has a cosine of 0 with everything.
    """
    u = df.withColumn("_n", F.sqrt(dot(F.col(vector), F.col(vector))))
    share = F.when(F.col("_n") > 0, F.col("v").cast("double") / F.col("_n")).otherwise(0.0)
    parts = u.select(cluster, "_n", F.posexplode(vector).alias("i", "v")).groupBy(cluster, "i").agg(F.sum(share).alias("v"))
    total = parts.groupBy(cluster).agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("s")).select(F.col(cluster).alias("_c"), F.transform("s", lambda x: x["v"]).alias("_s"))
    out = u.join(total, F.col(cluster).eqNullSafe(F.col("_c")))
    return out.withColumn("centrality", F.when(F.col("_n") > 0, dot(F.col(vector), F.col("_s")) / F.col("_n")).otherwise(0.0)).drop("_c", "_s", "_n", vector)


def kmeans(df: DataFrame, k: int = 5, vector: str = "embedding", seed: int = 42) -> DataFrame:
    """Column cluster."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = df.withColumn("features", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    return KMeans(k=k, seed=seed, predictionCol="cluster").fit(rows).transform(rows).drop("features")


def _chunks(block: int):
    """Rows (key, vector) to one row per ``block``: the keys, and the vectors' numbers as bytes."""

    def pack(keys: list, vecs: list) -> pa.RecordBatch:
        data = np.array(vecs, np.float64).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([keys], pa.list_(pa.int64())), pa.array([data], pa.binary())], names=["ids", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        vecs: list = []
        for b in batches:
            keys += b.column(0).to_pylist()
            vecs += b.column(1).to_pylist()
            while len(keys) >= block:
                yield pack(keys[:block], vecs[:block])
                keys, vecs = keys[block:], vecs[block:]
        if keys:
            yield pack(keys, vecs)

    return run


def _best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, x, keys, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                q, r = np.array(ids), np.array(keys)
                vq, vr = np.frombuffer(x).reshape(len(q), -1), np.frombuffer(y).reshape(len(r), -1)
                d = np.sqrt(np.maximum((vq**2).sum(1)[:, None] - 2 * vq @ vr.T + (vr**2).sum(1)[None, :], 0))
                d[q[:, None] == r[None, :]] = np.inf
                order = np.lexsort((np.broadcast_to(r, d.shape), d), axis=1)[:, : min(k, len(r))]
                cols = [np.repeat(q, order.shape[1]), r[order].ravel(), np.take_along_axis(d, order, 1).ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["query_id", "key", "distance"])

    return run


def nearest(df: DataFrame, queries: DataFrame, key: str, k: int, vector: str = "embedding", block: int = 1024) -> DataFrame:
    """The k rows nearest to each query row by Euclidean distance, itself left out: query_id, key, distance, rank.

    Exact: queries and rows are packed into blocks, each query block meets each row block once, and only the k best of a
    query in a row block are passed on.  Rows with a null key or vector are left out; ties go to the smaller key.
    """
    shape = "ids array<bigint>, data binary"
    pack = lambda t: t.select(F.col(key).cast("bigint").alias("key"), vector).dropna().mapInArrow(_chunks(block), shape)
    pairs = pack(queries).crossJoin(pack(df).withColumnsRenamed({"ids": "ids2", "data": "data2"}))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = pairs.repartition(n).mapInArrow(_best(k), "query_id bigint, key bigint, distance double").filter("distance < double('infinity')")
    w = Window.partitionBy("query_id").orderBy("distance", "key")
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).withColumnRenamed("key", key)


def _alike(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                sides = []
                for col in (3, 4):
                    keys, vecs = b.column(col)[r].values.flatten()
                    v = vecs.flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1)
                    n = np.sqrt((v**2).sum(1))
                    sides.append((keys.to_numpy(zero_copy_only=False), v / np.where(n > 0, n, 1)[:, None]))
                (p, u), (q, v) = sides
                score = u @ v.T
                hit = score > least
                if b.column(1)[r] == b.column(2)[r]:  # a block with itself
                    hit &= p[:, None] < q[None, :]
                i, j = np.nonzero(hit)
                cols = [np.minimum(p[i], q[j]), np.maximum(p[i], q[j]), score[i, j]]
                cluster = pa.array([b.column(0)[r].as_py()] * len(i), b.schema.field(0).type)
                yield pa.RecordBatch.from_arrays([cluster, *(pa.array(c) for c in cols)], names=["cluster", "first_id", "second_id", "similarity"])

    return run


def alike_in_clusters(df: DataFrame, cluster: str, key: str, least: float, vector: str = "embedding", block: int = 1024) -> DataFrame:
    """All pairs of rows of one cluster whose cosine is above ``least``: the cluster, first_id, second_id, similarity.

    Exact: a cluster is spread over blocks of about ``block`` rows, and each block meets itself and each other block of
    its cluster in a task of their own.  Rows with a null cluster, key or vector are left out; keys are unique; a zero
    vector has a cosine of 0 with everything.
    """
    rows = df.select(F.col(cluster).alias("cluster"), F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("v")).dropna()
    parts = rows.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n"))
    placed = rows.join(parts, "cluster").withColumn("at", F.pmod(F.xxhash64("key"), "n").cast("int"))
    blocks = placed.groupBy("cluster", "n", "at").agg(F.collect_list(F.struct("key", "v")).alias("rows"))
    left = blocks.select("cluster", F.col("at").alias("i"), F.explode(F.sequence("at", F.col("n") - 1)).alias("j"), F.col("rows").alias("x"))
    right = blocks.select("cluster", F.explode(F.sequence(F.lit(0), "at")).alias("i"), F.col("at").alias("j"), F.col("rows").alias("y"))
    pairs = left.join(right, ["cluster", "i", "j"]).select("cluster", "i", "j", "x", "y")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = rows.schema["cluster"].dataType.simpleString()
    out = pairs.repartition(n, "cluster", "i", "j").mapInArrow(_alike(least), f"cluster {kind}, first_id bigint, second_id bigint, similarity double")
    return out.withColumnRenamed("cluster", cluster)
