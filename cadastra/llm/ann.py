"""Approximate nearest neighbours: one robust-pruned graph per shard, searched by beams.

Vectors are dealt to shards of about ``SHARD_ROWS`` by a hash of their id, so no shard grows with the data. Each
shard holds vectors of one band of norms (``BAND``), so that a few very long vectors do not make all others look alike. A
shard's graph is built in one task and stored as a table of neighbour lists. Queries go to every shard in blocks of
``QUERY_BLOCK``; a task searches one shard for one block, scores what the beam found in double precision, and the best of all
shards are kept.

Nearness is the inner product. Vectors get one more component so that all have their shard's largest norm, which makes the
largest inner product the smallest distance. Equal vectors of a shard are one node of its graph; their ids stand in
line by size.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without
vec_id; of rows that repeat a vec_id the smallest vector counts; vectors of different length are not compared; queries with fewer
candidates get all of them; an empty table gives no rows; columns of the input with other names are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import scratch_folder, stored
from cadastra.llm.vamana import beam_search, build

SHARD_ROWS = 4_096
#: Largest ratio of norms in a shard.
BAND = 16
QUERY_BLOCK = 8_192
NEIGHBOURS = 20
BEAM = 128
SEARCH_BATCH = 256


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector, dim): one double vector per id."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(vector, lambda x: x != 0)
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & nonzero)
    one = rows.groupBy("vec_id").agg(F.min(vector).alias("vector"))
    return one.select(F.col("vec_id").cast("long").alias("vec_id"), "vector", F.size("vector").alias("dim"))


def norms(vectors: np.ndarray) -> np.ndarray:
    """Euclidean norms, also of rows whose squares are no finite or no positive doubles."""
    most = np.abs(vectors).max(1)
    return most * np.sqrt(((vectors / most[:, None]) ** 2).sum(1))


def levelled(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled by their largest norm, with the component that makes each norm one, in double precision."""
    most = np.abs(vectors).max()
    scaled = vectors / most
    scaled /= norms(scaled).max()
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(1), 0))
    return np.column_stack([scaled, rest])


def graph_of(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per distinct vector of a shard: its node number, ids, neighbour list, and whether search starts there."""
    rows = rows.sort_values("vec_id")
    vectors = np.stack(rows["vector"].to_numpy())
    distinct, node = np.unique(vectors, axis=0, return_inverse=True)
    members = rows["vec_id"].groupby(node.ravel()).apply(list)
    graph, entry = build(levelled(distinct))
    return pd.DataFrame(
        {
            "dim": rows["dim"].iloc[0],
            "shard": rows["shard"].iloc[0],
            "node": np.arange(len(distinct)),
            "ids": members.to_numpy(),
            "vector": list(distinct),
            "near": [n[n >= 0] for n in graph],
            "entry": np.arange(len(distinct)) == entry,
        }
    )


def searched(shard: pd.DataFrame, queries: pd.DataFrame, neighbours: int, beam: int) -> pd.DataFrame:
    """The ``neighbours`` best of one shard for each query of one block."""
    names = ["query_id", "vec_id", "score"]
    if shard.empty or queries.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
    shard = shard.sort_values("node")
    vectors = np.stack(shard["vector"].to_numpy())
    width = max(1, max(map(len, shard["near"])))
    graph = np.full((len(shard), width), -1, np.int64)
    for row, near in enumerate(shard["near"]):
        graph[row, : len(near)] = near
    entry = int(np.flatnonzero(shard["entry"].to_numpy())[0])
    points, ids = levelled(vectors).astype(np.float32), shard["ids"].to_list()
    out = []
    for start in range(0, len(queries), SEARCH_BATCH):
        part = queries.iloc[start : start + SEARCH_BATCH]
        asked = np.stack(part["vector"].to_numpy())
        level = np.column_stack([asked / np.abs(asked).max(1, keepdims=True), np.zeros(len(asked))]).astype(np.float32)
        found, _ = beam_search(level, points, graph, entry, max(beam, neighbours + 1))
        for query, vector, nodes in zip(part["vec_id"], asked, found):
            nodes = nodes[nodes >= 0]
            # equal vectors have equal scores; the smallest ids of a node come first
            scores = (vectors[nodes] * vector).sum(1)
            pairs = [
                (-score, v) for score, n in zip(scores, nodes) for v in ids[n][: neighbours + 1] if v != query
            ]
            out += [(query, v, -s) for s, v in sorted(pairs)[:neighbours]]
    return pd.DataFrame(out, columns=names)


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """The stored graphs and the number of shards, for rows from ``usable``. Bands are counted from the largest norm down."""
    most = F.array_max(F.transform("vector", F.abs))
    ratio = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / most) * (x / most)))
    # logarithms, as neither the largest norm nor a ratio of norms need be a finite double
    size = F.log(most) + F.log(ratio)
    sized = vectors.withColumn("size", size)
    largest = sized.agg(F.max("size")).first()[0] or 0.0
    banded = sized.withColumn("band", F.floor((F.lit(largest) - F.col("size")) / float(np.log(BAND))).cast("int"))
    # a finite double leaves some 530 bands at most
    counts = sorted((r["band"], r["count"]) for r in banded.groupBy("band").count().collect())
    cut, shards = {}, 0
    for band, rows in counts:
        cut[band] = (shards, -(-rows // shard_rows))
        shards += cut[band][1]
    spark = vectors.sparkSession
    table = spark.createDataFrame([(b, s, n) for b, (s, n) in cut.items()], "band int, first int, shards int")
    place = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int")
    dealt = banded.join(F.broadcast(table), "band").select("vec_id", "vector", "dim", place.alias("shard"))
    graphs = dealt.groupBy("dim", "shard").applyInPandas(
        graph_of, "dim int, shard int, node int, ids array<long>, vector array<double>, near array<int>, entry boolean"
    )
    return stored(graphs, scratch_folder(spark, "graphs")), max(1, shards)


def search(
    graphs: DataFrame,
    queries: DataFrame,
    shards: int,
    neighbours: int = NEIGHBOURS,
    beam: int = BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` (vec_id, vector, dim)."""
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = queries.withColumns(
        {
            "block": F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"),
            "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))),
        }
    )
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = (
        held.groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInPandas(
            lambda shard, part: searched(shard, part, neighbours, beam), "query_id long, vec_id long, score double"
        )
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= neighbours)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, is_query, neighbours: int = NEIGHBOURS, beam: int = BEAM, shard_rows: int = SHARD_ROWS):
    """Index every usable row; search for those for which ``is_query`` (a condition on vec_id) holds."""
    vectors = stored(usable(embeddings), scratch_folder(embeddings.sparkSession, "vectors"))
    graphs, shards = index(vectors, shard_rows)
    return search(graphs, vectors.where(is_query), shards, neighbours, beam)
