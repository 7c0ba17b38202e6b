"""Votes recomputed by hand; the stages of the pipeline on a small corpus with planted copies, passages and junk."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cadastra.llm import quality, sharding
from tests.llm.helpers import SCHEMA, awkward

WORDS = [a + b for a in ("ba", "lo", "mi", "ten", "ru", "sol", "ka", "fe") for b in ("na", "rio", "t", "var", "chen", "dum", "lis", "po", "gar")]


def prose(seed, n):
    chosen = random.Random(str(seed))
    return " ".join(chosen.choice(WORDS) for _ in range(n))


def test_scores_are_weighted_votes_of_the_nearest(spark):
    texts = [prose(n, 60) if n % 3 else "|".join("X9#" for _ in range(40 + n)) for n in range(60)]
    docs = spark.createDataFrame([(n, t, "en", "s", len(t)) for n, t in enumerate(texts)], SCHEMA)
    # a labelled document that is repeated, and labels of documents that are not there
    docs = docs.unionAll(docs.where("doc_id < 5"))
    labels = spark.createDataFrame([(n, int(n % 3 > 0)) for n in range(80)] + [(7, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    kept = {r[0] for r in docs.where(~quality.held_out(F.col("doc_id"))).select("doc_id").distinct().collect()}
    assert len(model.labels) == len(kept)
    assert sorted(model.labels.tolist()) == sorted(float(n % 3 > 0 and n != 7) for n in kept)
    for row in quality.scored(docs, model).collect():
        vector = (quality.term_weights(row.text) * model.weights) @ model.projection
        vector = vector / max(np.linalg.norm(vector), 1e-12)
        cosines = model.vectors @ vector
        nearest = np.argsort(-cosines, kind="stable")[: quality.NEIGHBOURS]
        weight = np.maximum(cosines[nearest].astype(float), 1e-6)
        rest = np.sort(-cosines)[quality.NEIGHBOURS - 1 : quality.NEIGHBOURS + 1]
        if rest[1] - rest[0] > 1e-5:  # no tie at the border
            assert row.score == pytest.approx((weight * model.labels[nearest]).sum() / weight.sum(), abs=1e-4)
    few = quality.fit(docs, labels, max_labelled=10)
    assert len(few.labels) == 10


def test_table_of_slots_from_the_definition():
    """Shards take turns, each claiming the first free slot of its own permutation of all slots."""
    names, size = ("a", "b", "c", "d"), 101
    orders = []
    for name in names:
        digest = hashlib.sha256(name.encode()).hexdigest()
        start, stride = int(digest[:16], 16) % size, int(digest[16:32], 16) % (size - 1) + 1
        orders.append([(start + i * stride) % size for i in range(size)])
        assert sorted(orders[-1]) == list(range(size))
    owner: dict[int, int] = {}
    while len(owner) < size:
        for shard, order in enumerate(orders):
            free = [slot for slot in order if slot not in owner]
            if free:
                owner[free[0]] = shard
    assert sharding.fill(names, size) == [owner[slot] for slot in range(size)]
    # a shard that leaves gives up its slots; few others move
    fewer = sharding.fill(names[:3], size)
    moved = sum(owner[slot] != fewer[slot] for slot in range(size) if owner[slot] < 3)
    assert moved < 0.4 * size


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, kinds = [], {}

    def add(kind, text, quality_label=1):
        n = len(rows)
        rows.append((n, text, "en", "abc"[n % 3], len(text), quality_label))
        kinds.setdefault(kind, []).append(n)

    for n in range(150):
        add("clean", prose(n, 120))
    passage = prose("passage", 25)
    for n in range(40):
        add("junk", "|".join("#Q7=" for _ in range(60 + n)), 0)
    for n in range(12):
        add("exact", prose(n, 120))
        words = prose(n + 20, 120).split()
        words[60] = "changed"
        add("near", " ".join(words))
        add("leak", f"{prose(('a', n), 50)} {passage} {prose(('b', n), 50)}")
    docs = spark.createDataFrame([r[:5] for r in rows], SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], r[5], 0) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, kinds


def ids_of(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_each_stage_takes_what_it_should(spark, corpus):
    folder, docs, kinds = corpus
    stages = dict(corpus_pipeline.STAGES)
    clean, everything = set(kinds["clean"]), ids_of(docs)
    kept = ids_of(stages["quality classifier"](spark, docs, folder))
    assert everything - kept == set(kinds["junk"])
    kept = ids_of(stages["SimHash near-dedup"](spark, docs.where(~F.col("doc_id").isin(kinds["junk"])), folder))
    assert kept == everything - set(kinds["junk"]) - set(kinds["exact"]) - set(kinds["near"])
    kept = ids_of(stages["benchmark decontamination"](spark, docs, folder))
    assert kept == everything - set(kinds["leak"])
    mixed = stages["mixing sources to target weights"](spark, docs.where(F.col("doc_id").isin(*clean)), folder)
    assert mixed.columns == docs.columns and ids_of(mixed) <= clean


def test_whole_pipeline(spark, corpus):
    folder, docs, kinds = corpus
    kept = ids_of(corpus_pipeline.run(spark, folder))
    gone = {n for kind in ("junk", "exact", "near", "leak") for n in kinds[kind]}
    assert kept and not kept & gone


def test_stages_stand_awkward_and_empty_tables(spark, corpus):
    folder = corpus[0]
    for table in (awkward(spark), awkward(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, folder)
            out.write.format("noop").mode("overwrite").save()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == table.columns, name
