"""Hard-negative mining with anchor spanning-tree bounds.

A row's score is its integer inner product with the anchor, on components scaled and rounded down to integers. An anchor's positives
are its best rows of the same label; hard negatives are rows of other labels whose score lies in a window below a
positive's score.

Anchors stand in blocks of at most ``ANCHOR_BLOCK``, candidates in blocks of at most ``MOST_ROWS``, dealt by label and hash, so no label
makes a block grow. Positives come from blocked products within a label. For negatives each anchor block gets a minimum
spanning tree. In a task (one anchor block, one candidate block) the root scores all candidates; along an edge from parent
to child a candidate's score moves by the edge times the block's mean vector, give or take the edge's length times the candidate's
distance from that mean. Only candidates whose bounds overlap a window, and that may still be among its first, are rescored;
the others keep their bounds for the children. Bounds carry a margin for rounding, so nothing is lost.

Defined results: rows without vec_id, with a null label, a null or empty vector, a null or non-finite component take no part, nor do
rows whose scaled vector is 2**31 or longer, as scores of such need not fit a long. Of rows that repeat a vec_id the one with
the smallest label, then vector, counts. Vectors of different length are not compared. Anchors without other rows of their label
have no positives and no result. Ties go to the smaller vec_id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import scratch_folder, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Lowest and highest negative score in per cent of the positive's.
LOW, HIGH = 50, 95
ANCHOR_BLOCK = 2_048
LEAST_ROWS, MOST_ROWS = 2_048, 65_536
#: Labels are hashed to so many buckets before they are cut into blocks.
BUCKETS = 64
SPAN = 128
MOST_TASKS = 20_000
EXACT = float(1 << 52)
MARGIN = 1 + 1e-9
CELLS = 1 << 22


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector, dim): one integer vector, held in doubles, per id."""
    raw = F.col("embedding").cast("array<double>")
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor() of a double gives a long; longer components belong to vectors that take no part
    small = F.forall(raw, lambda x: F.abs(x) * SCALE < float(1 << 31))
    rows = embeddings.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0").where(finite & small)
    vector = F.transform(raw, lambda x: F.floor(x * SCALE).cast("double"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct("label", vector.alias("vector")).alias("row"))
    one = rows.groupBy("vec_id").agg(F.min("row").alias("row"))
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    found = one.select("vec_id", "row.label", "row.vector", F.size("row.vector").alias("dim"))
    return found.where(length < float(1 << 62))


def cut(rows: DataFrame, size: int, buckets: int, name: str) -> tuple[DataFrame, DataFrame, int]:
    """``rows`` with their block number ``name``, the (bucket, first, blocks) table, and the number of blocks.

    A bucket of labels is cut by a hash of the ids into blocks of about ``size`` rows."""
    bucket = F.pmod(F.xxhash64("label"), F.lit(buckets)).cast("int")
    counts = {r["bucket"]: r["count"] for r in rows.groupBy(bucket.alias("bucket")).count().collect()}
    first, table = 0, []
    for number in range(buckets):
        blocks = -(-counts.get(number, 0) // size)
        table.append((number, first, blocks))
        first += blocks
    table = rows.sparkSession.createDataFrame(table, f"{name}_bucket int, {name}_first int, {name}_blocks int")
    place = F.col(f"{name}_first") + F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col(f"{name}_blocks")).cast("int")
    dealt = rows.withColumn(f"{name}_bucket", bucket).join(F.broadcast(table), f"{name}_bucket")
    return dealt.withColumn(name, place).drop(*table.columns), table, first


def within_labels(rows: DataFrame, table: DataFrame, buckets: int, name: str) -> DataFrame:
    """A row for every block ``name`` that may hold rows of the row's label."""
    bucket = F.pmod(F.xxhash64("label"), F.lit(buckets)).cast("int").alias(f"{name}_bucket")
    met = rows.select("*", bucket).join(F.broadcast(table.where(f"{name}_blocks > 0")), f"{name}_bucket")
    last = F.col(f"{name}_first") + F.col(f"{name}_blocks") - 1
    return met.withColumn(name, F.explode(F.sequence(f"{name}_first", last))).drop(*table.columns)


def all_blocks(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def matrix(table: pa.Table) -> np.ndarray:
    values = np.concatenate([c.flatten().to_numpy() for c in table["vector"].chunks])
    return values.reshape(len(table), -1)


def lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(1))


def products(rows: np.ndarray, others: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products: in doubles while every sum stays below 2**52, else in 64-bit integers."""
    if bound < EXACT:
        return rows @ others.T
    return rows.astype(np.int64) @ others.astype(np.int64).T


def codes(*tables: pa.Table) -> list[np.ndarray]:
    """Labels as numbers that are equal just if the labels are."""
    every = np.concatenate([np.asarray(t["label"].to_pylist()) for t in tables])
    found = np.unique(every, return_inverse=True)[1].ravel()
    return np.split(found, np.cumsum([len(t) for t in tables])[:-1])


def largest(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest values, largest first, ties by place."""
    if len(values) > k:
        least = np.partition(values, len(values) - k)[len(values) - k]
        above = np.flatnonzero(values > least)
        chosen = np.concatenate([above, np.flatnonzero(values == least)[: k - len(above)]])
    else:
        chosen = np.arange(len(values))
    return chosen[np.lexsort((chosen, -values[chosen]))]


def positives_of(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The ``k`` best rows of the same label of one candidate block, for each anchor of one block."""
    out = {"anchor_id": [], "vec_id": [], "score": []}
    if len(anchors) and len(rows):
        rows = rows.sort_by("vec_id")
        mine, theirs = codes(anchors, rows)
        asked, held = matrix(anchors), matrix(rows)
        asked_ids, ids = anchors["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
        bound = lengths(asked).max() * lengths(held).max()
        for label in np.unique(mine):
            same = np.flatnonzero(theirs == label)
            some = np.flatnonzero(mine == label)
            part = max(1, CELLS // max(1, len(same)))
            for start in range(0, len(some) if len(same) else 0, part):
                scores = products(asked[some[start : start + part]], held[same], bound)
                for row, line in zip(some[start : start + part], scores):
                    others = ids[same] != asked_ids[row]
                    best = largest(line[others], k)
                    out["anchor_id"].append(np.full(len(best), asked_ids[row]))
                    out["vec_id"].append(ids[same][others][best])
                    out["score"].append(line[others][best].astype(np.int64))
    return pa.table({name: pa.array(np.concatenate([np.zeros(0, np.int64), *parts])) for name, parts in out.items()})


def with_tree(table: pa.Table) -> pa.Table:
    """(vec_id, place, parent): a block's anchors in an order in which parents come first, with the place of each one's parent
    (its own for the root), from Prim's minimum spanning tree of the Euclidean distances."""
    table = table.sort_by("vec_id")
    points = matrix(table)
    n = len(points)
    near, parent = np.full(n, np.inf), np.zeros(n, np.int64)
    order, left, at = [], np.ones(n, bool), 0
    for _ in range(n):
        order.append(at)
        left[at] = False
        gap = points - points[at]
        gap = np.einsum("ij,ij->i", gap, gap)
        closer = left & (gap < near)
        near[closer], parent[closer] = gap[closer], at
        at = int(np.argmin(np.where(left, near, np.inf)))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return pa.table(
        {
            "vec_id": table["vec_id"].take(pa.array(order)),
            "place": pa.array(np.arange(n, dtype=np.int32)),
            "parent": pa.array(place[parent[order]].astype(np.int32)),
        }
    )


def in_windows(middle: np.ndarray, radius: np.ndarray, others: np.ndarray, windows: list[tuple[int, int]], k: int) -> np.ndarray:
    """Which candidates may be among the first ``k`` of a window, by the bounds of their scores."""
    low, high = middle - radius, middle + radius
    needed = np.zeros(len(middle), bool)
    for least, most in windows:
        overlap = others & (high >= least) & (low <= most)
        inside = low[overlap & (low >= least) & (high <= most)]
        if len(inside) >= k:
            overlap &= high >= np.partition(inside, len(inside) - k)[len(inside) - k]
        needed |= overlap
    return needed


def negatives_of(
    anchors: pa.Table, rows: pa.Table, k: int, low: int, high: int, rescored: list[int] | None = None
) -> pa.Table:
    """The first ``k`` rows of one candidate block in every window of each anchor of one block.

    ``rescored`` gets the numbers of scores computed and of scores there are."""
    names = ["anchor_id", "positive_id", "vec_id", "positive_score", "score"]
    out: dict[str, list[np.ndarray]] = {name: [] for name in names}
    if len(anchors) and len(rows):
        anchors, rows = anchors.sort_by("place"), rows.sort_by("vec_id")
        mine, theirs = codes(anchors, rows)
        points, held, ids = matrix(anchors), matrix(rows), rows["vec_id"].to_numpy()
        parents, anchor_ids = anchors["parent"].to_numpy(), anchors["vec_id"].to_numpy()
        positives = anchors["positives"].to_pylist()
        bound = lengths(points).max() * lengths(held).max()
        mean = np.rint(held.mean(0))
        spread = lengths(held - mean) * MARGIN
        slack = 1 + 1e-9 * bound
        waiting = np.bincount(parents, minlength=len(points))
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for place, point in enumerate(points):
            windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in positives[place]]
            others = theirs != mine[place]
            if place == 0:
                middle, radius, needed = np.zeros(len(held)), np.zeros(len(held)), np.ones(len(held), bool)
            else:
                edge = point - points[parents[place]]
                before, wide = known[parents[place]]
                middle = before + edge @ mean
                radius = wide + spread * np.sqrt(edge @ edge) + slack
                needed = in_windows(middle, radius, others, windows, k)
            at = np.flatnonzero(needed)
            scores = products(held if len(at) == len(held) else held[at], point[None, :], bound)[:, 0]
            middle[at], radius[at] = scores, 0
            if rescored is not None:
                rescored[0] += len(at)
                rescored[1] += len(held)
            for positive, (least, most) in zip(positives[place], windows):
                found = np.flatnonzero(others[at] & (scores >= least) & (scores <= most))
                found = found[largest(scores[found], k)]
                if len(found):
                    out["anchor_id"].append(np.full(len(found), anchor_ids[place]))
                    out["positive_id"].append(np.full(len(found), positive["vec_id"]))
                    out["vec_id"].append(ids[at[found]])
                    out["positive_score"].append(np.full(len(found), positive["score"]))
                    out["score"].append(scores[found].astype(np.int64))
            # bounds are kept only while children wait for them
            above = int(parents[place])
            waiting[above] -= 1
            if waiting[place]:
                known[place] = (middle, radius)
            if not waiting[above]:
                known.pop(above, None)
    return pa.table({name: pa.array(np.concatenate([np.zeros(0, np.int64), *parts])) for name, parts in out.items()})


def first_of(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def paired(anchors: DataFrame, rows: DataFrame, tasks: int, function, schema: str) -> DataFrame:
    """``function`` of each pair of an anchor block and a candidate block that meet."""
    keys = ["dim", "asked", "held"]
    tasks = max(1, min(tasks, MOST_TASKS))
    left, right = (df.repartition(tasks, *keys).groupBy(*keys) for df in (anchors, rows))
    return left.cogroup(right).applyInArrow(function, schema)


def mine(
    embeddings: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows for which ``is_anchor`` (a
    condition on vec_id) holds."""
    spark = embeddings.sparkSession
    folder = scratch_folder(spark, "hard-negatives")
    rows = stored(usable(embeddings), f"{folder}/rows")
    size = min(max(-(-rows.count() // SPAN), LEAST_ROWS), MOST_ROWS)
    held, held_table, held_blocks = cut(rows, size, BUCKETS, "held")
    held = stored(held, f"{folder}/held")
    anchors = rows.where(is_anchor)
    buckets = min(max(anchors.count() // ANCHOR_BLOCK, 1), BUCKETS)
    asked, asked_table, asked_blocks = cut(anchors, ANCHOR_BLOCK, buckets, "asked")
    asked = stored(asked, f"{folder}/asked")
    tasks = asked_blocks * held_blocks
    scored = paired(
        within_labels(asked, held_table, BUCKETS, "held"),
        within_labels(held, asked_table, buckets, "asked"),
        tasks,
        partial(positives_of, k=positives),
        "anchor_id long, vec_id long, score long",
    )
    best = first_of(scored, ["anchor_id"], positives)
    lists = best.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    known = stored(asked.join(lists, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), f"{folder}/known")
    trees = known.select("vec_id", "vector", "dim", "asked").groupBy("dim", "asked").applyInArrow(
        with_tree, "vec_id long, place int, parent int"
    )
    trees = stored(known.join(trees, "vec_id"), f"{folder}/trees")
    found = paired(
        all_blocks(trees, max(held_blocks, 1), "held"),
        all_blocks(held, max(asked_blocks, 1), "asked"),
        tasks,
        partial(negatives_of, k=negatives, low=low, high=high),
        "anchor_id long, positive_id long, vec_id long, positive_score long, score long",
    )
    return first_of(found, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
