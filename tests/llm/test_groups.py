"""Fingerprint groups, graph search, votes, mixing, sharding and URL rules against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cadastra.llm import ann, components, mixing, quality, sharding, simhash, urls
from tests.llm.helpers import LOWER, awkward, documents, rows

# SimHash.


def brute_fingerprint(text, width=4):
    words = [w for w in (text or "").translate(LOWER).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    size = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id per id, linking fingerprints at four bits or fewer."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints_follow_the_definition(spark):
    texts = [None, "", " \t", "One", "A b\x0bc D e", "É é " * 50, "a\u00a0b c d e f", " ".join(f"w{i}" for i in range(70_000))]
    got = [r.fps[0] & (2**64 - 1) for r in simhash.fingerprints(documents(spark, texts)).orderBy("doc_id").collect()]
    assert got == [brute_fingerprint(t) for t in texts]


def test_long_texts_are_counted_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 313}" for i in range(5_000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.fingerprint(text) == whole


def planted(seed, clusters, size):
    """Chains and clouds of fingerprints at up to five bits from each other."""
    dice = random.Random(seed)
    prints = {}
    for _ in range(clusters):
        value = dice.getrandbits(64)
        for _ in range(size):
            prints[len(prints)] = value
            for bit in dice.sample(range(64), dice.randint(0, 5)):
                value ^= 1 << bit
    return prints


@pytest.mark.parametrize("small_entry", [1, 3, 32])
def test_links_join_just_what_is_near(spark, monkeypatch, small_entry):
    monkeypatch.setattr(simhash, "SMALL_ENTRY", small_entry)
    prints = planted(small_entry, 12, 9)
    distinct = sorted({v - (1 << 64) if v >> 63 else v for v in prints.values()})
    table = spark.createDataFrame([(0, v) for v in distinct], "kind int, fp long")
    links = simhash.links_of(table)
    assert links.count() < 70 * len(distinct)
    parts = components.components(links.select("a", "b"))
    got = defaultdict(set)
    for node, root in parts.collect():
        got[root].add(node)
    expected = defaultdict(set)
    by_value = {v: v & (2**64 - 1) for v in distinct}
    for node, root in brute_components(by_value).items():
        expected[root].add(node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in expected.values() if len(x) > 1)


def test_components_of_a_long_chain(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components.components(chain)
    assert found.select("root").distinct().count() == 1 and found.count() == 301


def test_groups_of_texts(spark):
    dice = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(8):
        base = dice.choices(words, k=300)
        for _ in range(4):
            copy = list(base)
            for _ in range(dice.randint(0, 3)):
                copy[dice.randrange(300)] = "new"
            texts.append(" ".join(copy))
    texts += ["", None, "one", "ONE"]
    found = {r.doc_id: r.component_id for r in simhash.groups(documents(spark, texts)).collect()}
    assert found == brute_components({i: brute_fingerprint(t) for i, t in enumerate(texts)})


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"v{i}" for i in range(200))
    docs = documents(spark, ["other words here", text, text + " tail", text, None, ""], ids=[5, 3, 2, 3, None, None])
    features = (simhash.Feature(5), simhash.Feature(1, True, 42), simhash.Feature(1, True, 43))
    for chosen in ((simhash.Feature(),), features):
        kept = simhash.one_of_each(docs, chosen)
        assert kept.columns == docs.columns
        assert rows(kept, "doc_id") == [(2,), (5,), (None,)]


def brute_kept(texts):
    """Smallest id of each component of pairs with a similarity of four fifths or more."""
    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root = [root[b] if r == root[a] else r for r in root]
    return {min(i for i, r in enumerate(root) if r == x) for x in set(root)}


@pytest.mark.parametrize("block", [2, 256])
def test_only_texts_that_share_shingles_are_copies(spark, monkeypatch, block):
    """Other orders of the same words have the same fingerprints of distinct words, but are other texts."""
    monkeypatch.setattr(simhash, "BLOCK_TEXTS", block)
    dice = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = [None, "", "one", "ONE", "one two"]
    for _ in range(5):
        words = dice.sample(base, 120)
        texts += [" ".join(words), " ".join(words).upper(), " ".join(words[:60] + words[61:]), " ".join(words[:60] + words)]
    features = tuple(simhash.Feature(1, True, seed) for seed in (42, 43, 44))
    docs = documents(spark, texts)
    assert len({r.component_id for r in simhash.groups(docs, features).where("doc_id > 4").collect()}) == 1
    kept = simhash.one_of_each(docs, features)
    assert {r.doc_id for r in kept.collect()} == brute_kept(texts)


def test_groups_of_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    assert simhash.groups(docs).count() == docs.count()
    assert simhash.groups(docs.limit(0)).count() == 0
    assert simhash.one_of_each(docs.limit(0)).count() == 0
    assert simhash.one_of_each(docs).columns == docs.columns


# Graph search.


def vectors(spark, matrix, ids=None):
    data = [(int(i if ids is None else ids[i]), [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>")


def brute_nearest(matrix, every, k):
    matrix = np.asarray(matrix, np.float32).astype(np.float64)
    out = {}
    for q in range(0, len(matrix), every):
        scores = [((matrix[q] * matrix[i]).sum(), i) for i in range(len(matrix)) if i != q]
        out[q] = sorted(scores, key=lambda x: (-x[0], x[1]))[:k]
    return out


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_and_scores_over_several_shards(spark, spread):
    """Over vectors of different norms, with groups of equal and of nearly equal ones."""
    dice = np.random.default_rng(3)
    centres = dice.normal(size=(20, 32))
    matrix = centres[dice.integers(0, 20, 2400)] + 0.5 * dice.normal(size=(2400, 32))
    matrix *= np.exp(spread * 0.3 * dice.normal(size=(2400, 1)))
    matrix[500:560] = matrix[500]
    matrix[700:1000] = matrix[700] + 0.01 * dice.normal(size=(300, 32))
    found = ann.nearest(vectors(spark, matrix), F.col("vec_id") % 20 == 0, shard_rows=800).collect()
    expected = brute_nearest(matrix, 20, 20)
    got = defaultdict(dict)
    for row in found:
        got[row.query_id][row.rank] = (row.vec_id, row.score)
    exact = np.asarray(matrix, np.float32).astype(np.float64)
    hits = 0
    for query, best in expected.items():
        assert sorted(got[query]) == list(range(1, 21))
        listed = [got[query][r] for r in range(1, 21)]
        assert listed == sorted(listed, key=lambda x: (-x[1], x[0]))
        assert all(abs(score - exact[query] @ exact[v]) < 1e-9 for v, score in listed)
        hits += len({v for v, _ in listed} & {i for _, i in best})
    assert hits / (20 * len(expected)) >= 0.95


@pytest.mark.parametrize("long", [1e4, 1e30])
def test_one_long_vector_spoils_no_graph(spark, long):
    dice = np.random.default_rng(8)
    matrix = dice.normal(size=(1200, 32))
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix[7] *= long
    found = ann.nearest(vectors(spark, matrix), F.col("vec_id") % 20 == 0, shard_rows=800).collect()
    expected = brute_nearest(matrix, 20, 20)
    got = defaultdict(set)
    for row in found:
        got[row.query_id].add(row.vec_id)
    assert sum(len(got[q] & {i for _, i in best}) for q, best in expected.items()) / (20 * len(expected)) >= 0.95


def test_unusable_vectors_and_small_tables(spark):
    data = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [0.5, 0.5])]
    data += [(5, [0.5, 0.5]), (None, [1.0, 1.0]), (6, [float("inf"), 0.0]), (7, []), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("node", F.lit("clash"))
    assert rows(ann.nearest(df, F.lit(True))) == [(0, 1, 5, 0.5), (5, 1, 0, 0.5)]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


# Quality votes.


def test_votes_separate_held_out_documents(spark):
    dice = random.Random(1)
    good = lambda: " ".join("".join(dice.choices("abcdefghij", k=dice.randint(2, 7))) for _ in range(60)) + "."
    bad = lambda: " ".join("".join(dice.choices("abcdefghij", k=4)).upper() + "!!" for _ in range(60))
    texts = [bad() if i % 4 == 0 else good() for i in range(200)] + [None, ""]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    out = quality.scored(docs, quality.fit(docs, labels)).withColumn("out", quality.held_out(F.col("doc_id"))).collect()
    assert len(out) == 202 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.out and r.doc_id < 200]
    assert held and all((r.score >= quality.THRESHOLD) == (r.doc_id % 4 != 0) for r in held)
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.scored(docs, quality.fit(docs, turned)).collect()}
    assert again == {r.doc_id: r.score for r in out}


def test_votes_on_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (8, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.scored(docs, quality.fit(docs, labels))
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == docs.count()
    assert quality.scored(docs.limit(0), quality.fit(docs, labels)).count() == 0
    none = quality.scored(docs, quality.fit(docs, labels.limit(0)))
    assert {r.score for r in none.collect()} == {0.5}


def test_quality_on_the_test_tables(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.scored(docs.select("doc_id", "text"), quality.fit(docs, labels)).join(labels, "doc_id")
    held = scored.where(quality.held_out(F.col("doc_id"))).collect()
    right = sum((r.score >= quality.THRESHOLD) == (r.quality == 1) for r in held)
    assert right / len(held) >= 0.95


# Mixing.


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[n] for n in capped)
        free = [n for n in names if n not in capped]
        share = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] > cap * sizes[n]}
        if not over:
            return {**share, **{n: cap * sizes[n] for n in capped}}
        capped |= over


def test_targets_stop_at_the_cap_and_the_excess_is_shared_again(spark):
    sources = ["a"] * 2 + ["b"] * 40 + ["c"] * 3 + ["d"] + [None] * 30 + ["é"] * 5 + ["z"]
    texts = ["w " * (3 + i % 17) for i in range(len(sources) - 1)] + [None]
    docs = documents(spark, texts, sources=sources)
    sizes = Counter()
    for source, text in zip(sources, texts):
        sizes[source] += len((text or "").split())
    got = {r.mix_source: r.target for r in mixing.targets(mixing.sized(docs)).collect()}
    assert got == pytest.approx(brute_targets(dict(sizes)))


def test_every_source_gives_its_target_in_words(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCUMENTS", 7)
    dice = random.Random(2)
    sources = [dice.choice("aaaaabcde") for _ in range(300)]
    texts = ["word " * dice.randint(0, 90) for _ in sources]
    docs = documents(spark, texts, sources=sources)
    sized = mixing.sized(docs, "doc_id")
    out = mixing.mix(sized, mixing.draws(sized, levels=2)).collect()
    taken, target, shards = Counter(), {}, Counter()
    for row in out:
        words = sum(d.words for d in row.draws)
        assert words <= 3 * row.size
        taken[row.mix_source] += words
        target[row.mix_source] = row.target
        shards.update(d.shard for d in row.draws)
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert set(shards) <= set(range(4)) and len(shards) > 1
    mixed = mixing.materialised(docs, levels=2)
    words = Counter()
    for row in mixed.collect():
        words[row.source] += len(row.text.split())
        assert row.n_chars == len(row.text)
    assert mixed.columns == docs.columns and words == +taken


def test_quotas_are_split_exactly_and_at_random(spark):
    draws = {"a": 1000, "b": 37, "c": 1, None: 0, "d": 410}
    table = spark.createDataFrame(list(draws.items()), "mix_source string, draws long")
    means = Counter()
    for seed in range(12):
        split = mixing.shard_quotas(table, 3, seed).collect()
        per_source, per_shard = Counter(), Counter()
        for row in split:
            assert row.quota >= 0
            per_source[row.mix_source] += row.quota
            per_shard[row.shard] += row.quota
            means[row.mix_source, row.shard] += row.quota / 12
        assert per_source == +Counter(draws) and set(per_shard.values()) == {181}
    assert all(abs(means["a", s] - 125) < 12 for s in range(8))
    assert len({round(means["a", s], 3) for s in range(8)}) > 1


def test_hypergeometric_frequencies(spark):
    df = spark.range(4000).select(
        mixing.hypergeometric(F.lit(12).cast("long"), F.lit(5).cast("long"), F.lit(4).cast("long"), (F.col("id") + 0.5) / 4000).alias("k")
    )
    counted = {r.k: r["count"] / 4000 for r in df.groupBy("k").count().collect()}
    exact = {0: 56 / 792, 1: 280 / 792, 2: 336 / 792, 3: 112 / 792, 4: 8 / 792}
    assert counted == pytest.approx(exact, abs=1e-3)


def test_mixing_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    sized = mixing.sized(docs, "doc_id")
    assert mixing.mix(sized, mixing.draws(sized)).count() == docs.count()
    assert mixing.materialised(docs).columns == docs.columns
    none = mixing.sized(docs.limit(0), "doc_id")
    assert mixing.mix(none, mixing.draws(none)).count() == 0


# Sharding.


def test_slots_are_shared_evenly_and_stay_when_a_shard_goes():
    shards = tuple(f"s{i}" for i in range(7))
    full = sharding.fill(shards, 1009)
    counts = Counter(full)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(7))
    fewer = sharding.fill(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(full, fewer) if a != 6)
    assert moved < 0.25 * 1009
    for wrong in ((shards, 1010), ((), 11), (("a", "a"), 11), (shards, 7)):
        with pytest.raises(ValueError):
            sharding.fill(*wrong)


def test_placement_follows_the_table(spark):
    docs = awkward(spark)
    placed = sharding.place(docs)
    table = sharding.fill(sharding.SHARDS)
    for row in placed.collect():
        assert row.shard == sharding.SHARDS[table[row.slot]]
    assert placed.count() == docs.count() and set(placed.columns) == set(docs.columns)
    ids = spark.range(20_000).selectExpr("id doc_id", "string(id) text", "1 slot")
    counts = [r["count"] for r in sharding.place(ids).groupBy("shard").count().collect()]
    assert len(counts) == 16 and max(counts) < 1.2 * min(counts)
    assert sharding.place(docs.limit(0)).count() == 0


def test_shards_are_written_in_folders(spark, tmp_path):
    docs = documents(spark, [f"text {i}" for i in range(200)])
    sharding.write_shards(docs, str(tmp_path / "shards"), files=2)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows(back, "doc_id", "shard") == rows(sharding.place(docs), "doc_id", "shard")


# URL rules.

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def brute_verdict(url, rules):
    _, found, rest = (url or "").partition("://")
    if not found:
        rest = ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut].translate(LOWER), rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_the_longest_rule_decides(spark):
    dice = random.Random(4)
    hosts = ["example.org", "A.Example.ORG", "org", "xorg", "example.com", "com", "notexample.org", "", "a..com", "example.org:80"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/123?x=/de/", "/fr/", "/de/?q", "#/", "?a://b/c", "/é/de/"]
    given = [dice.choice(["http://", "HTTPS://", "x:\n//://", ""]) + dice.choice(hosts) + dice.choice(paths) for _ in range(300)]
    given += [None, "", "://", "://org/", "http://b://org/"]
    extra = [("block", "b.com", "/a"), ("allow", "com", "/aaa"), ("allow", "b.com", "/a")]
    given += ["http://b.com/aaa", "http://c.b.com/a"]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    out = urls.judge_urls(pages, urls.rule_table(spark, RULES + extra))
    expected = [(i, *brute_verdict(u, RULES + extra)) for i, u in enumerate(given)]
    assert rows(out, "page_id", "host", "path", "rule", "verdict") == sorted(expected, key=repr)


def test_urls_of_empty_tables_and_without_rules(spark):
    pages = spark.createDataFrame([(1, "http://example.org/es/x"), (1, "http://example.org/es/x"), (None, None)], "page_id long, url string")
    assert urls.judge_urls(pages.limit(0), urls.rule_table(spark, RULES)).count() == 0
    judged = urls.judge_urls(pages, urls.rule_table(spark, RULES).limit(0), default="block")
    assert [r.verdict for r in judged.collect()] == ["block"] * 3
    assert [r.verdict for r in urls.judge_urls(pages, urls.rule_table(spark, RULES)).collect()].count("block") == 2
