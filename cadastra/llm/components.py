"""Connected components of a link table by repeated contraction, entirely in shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import scratch_folder, stored

MAX_ROUNDS = 200


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long); nodes of a component share one root.

    In each round every node moves to that neighbour (or stays) which has the smallest hash in the round; links
    between moved nodes are the next round's. The number of links falls by a constant factor on average, hubs
    included, as a node needs only the smallest of its neighbours, found with partial aggregation. Each round's tables are
    written to the shared folder.
    """
    spark = links.sparkSession
    folder = scratch_folder(spark, "components")
    links = stored(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(),
        f"{folder}/links-0",
    )
    nodes = links.select(F.col("a").alias("node")).unionAll(links.select("b")).distinct()
    roots = stored(nodes.select("node", F.col("node").alias("root")), f"{folder}/roots-0")
    for turn in range(1, MAX_ROUNDS):
        if links.isEmpty():
            return roots
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def ranked(name: str, turn: int = turn):
            return F.struct(F.xxhash64(F.lit(turn), F.col(name)).alias("rank"), F.col(name).alias("node"))

        moves = stored(
            both.groupBy(F.col("a").alias("from")).agg(F.min(ranked("b")).alias("near")).select(
                "from",
                F.least("near", F.struct(F.xxhash64(F.lit(turn), "from").alias("rank"), F.col("from").alias("node")))[
                    "node"
                ].alias("to"),
            ),
            f"{folder}/moves-{turn}",
        )
        first = moves.select(F.col("from").alias("a"), F.col("to").alias("c"))
        second = moves.select(F.col("from").alias("b"), F.col("to").alias("d"))
        moved = links.join(first, "a").join(second, "b").where("c <> d")
        links = stored(
            moved.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct(),
            f"{folder}/links-{turn}",
        )
        step = moves.select(F.col("from").alias("root"), "to")
        roots = stored(
            roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")),
            f"{folder}/roots-{turn}",
        )
    raise RuntimeError("components did not settle")
