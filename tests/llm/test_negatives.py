"""Hard-negative mining against all pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadastra.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, every, positives=5, negatives=3):
    known = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        row = (label, [int(np.floor(256 * float(np.float32(x)))) for x in vector])
        known[vec_id] = min(row, known.get(vec_id, row))
    out = []
    for anchor, (label, vector) in known.items():
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, v)), i, y) for i, (y, v) in known.items() if i != anchor and len(v) == len(vector)]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            found = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(found, 1)]
    return sorted(out)


def cloud(n, dims=8, seed=1, spread=0.4, labels=4):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(labels, dims))
    chosen = random.integers(labels, size=n)
    points = (0.7 * centres[chosen] + centres[0] + random.normal(size=(n, dims)) * spread).astype("f4")
    return [(i, points[i].astype(float).tolist(), int(chosen[i])) for i in range(n)]


def mined(spark, rows, every=5):
    out = hardneg.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("sizes", [(2_048, 2_048, 65_536), (16, 8, 32)])
def test_equals_all_pairs(spark, monkeypatch, sizes):
    for name, value in zip(("ANCHOR_BLOCK", "LEAST_ROWS", "MOST_ROWS"), sizes):
        monkeypatch.setattr(hardneg, name, value)
    rows = cloud(300)
    expected = by_hand(rows, 5)
    assert len(expected) > 200 and mined(spark, rows) == expected


def test_awkward_rows(spark):
    rows = cloud(60, dims=3, labels=2)
    same = [0.5, 0.25, 0.0]
    rows += [(i, same, i % 2) for i in range(100, 160)]
    rows += [(200, None, 1), (205, [], 1), (210, [1.0, None, 1.0], 0), (215, [float("nan"), 1.0, 1.0], 0), (220, [1.0, 1.0, 1.0], None)]
    rows += [(225, [1.0, 2.0], 0), (226, [1.0, 2.5], 0), (227, [0.9, 1.5], 1), (None, same, 0), (230, [0.0, 0.0, 0.0], 7)]
    rows += [(235, [float("inf"), 1.0, 0.0], 1), (240, same, 0), (240, [0.4, 0.2, 0.1], 0), (240, same, 1)]
    rows += [(245, [9e4, -3e4, 1e3], 0), (246, [8e4, -2e4, 1e3], 0), (247, [7e4, -1e4, 1e3], 1), (248, [4e6, 1.0, 1.0], 1)]
    assert mined(spark, rows) == by_hand(rows, 5)


def test_too_long_vectors_take_no_part(spark):
    rows = cloud(40, dims=3, labels=2)
    assert mined(spark, [*rows, (50, [1e30, 1.0, 1.0], 0), (55, [9e6, 1.0, 1.0], 1)]) == by_hand(rows, 5)


def test_empty_table_and_lone_labels(spark):
    assert mined(spark, []) == []
    rows = [(0, [1.0, 0.0], 1), (5, [1.0, 0.1], 2)]
    assert mined(spark, rows) == []


def test_clashing_columns_and_text_labels(spark):
    rows = cloud(80)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("label", F.concat(F.lit("l"), "label"))
    df = df.withColumns({name: F.lit("kept") for name in ("rank", "score", "held", "asked", "vector", "dim", "place", "parent")})
    got = sorted(tuple(r) for r in hardneg.mine(df, F.col("vec_id") % 5 == 0).collect())
    assert got == by_hand(rows, 5)


def test_bounds_spare_scores_where_anchors_are_alike():
    random = np.random.default_rng(3)
    base, rows = random.normal(size=(2, 16)), 400
    near = np.rint(256 * (base[0] + 0.001 * random.normal(size=(20, 16))))
    others = np.rint(256 * random.normal(size=(rows, 16)))
    vectors = pa.array(list(near), pa.list_(pa.float64()))
    tree = hardneg.with_tree(pa.table({"vec_id": np.arange(20), "vector": vectors}))
    places = dict(zip(tree["vec_id"].to_pylist(), zip(tree["place"].to_pylist(), tree["parent"].to_pylist())))
    assert all(parent < place or place == parent == 0 for place, parent in places.values())
    top = int((near @ near.T).max())
    anchors = pa.table(
        {
            "vec_id": np.arange(20),
            "label": np.zeros(20, int),
            "vector": vectors,
            "positives": [[{"vec_id": 1000, "score": top}]] * 20,
            "place": [places[i][0] for i in range(20)],
            "parent": [places[i][1] for i in range(20)],
        }
    )
    held = pa.table({"vec_id": np.arange(100, 100 + rows), "label": np.ones(rows, int), "vector": pa.array(list(others), pa.list_(pa.float64()))})
    count = [0, 0]
    got = hardneg.negatives_of(anchors, held, 3, 20, 95, count)
    assert count[1] == 20 * rows and count[0] < 0.3 * count[1]
    for anchor in range(20):
        scores = others @ near[anchor]
        order = [i for i in np.lexsort((np.arange(rows), -scores)) if 20 * top <= 100 * scores[i] <= 95 * top][:3]
        rows_of = sorted((-s, v) for a, v, s in zip(*(got[c].to_pylist() for c in ("anchor_id", "vec_id", "score"))) if a == anchor)
        assert [v for _, v in rows_of] == [100 + i for i in order]
