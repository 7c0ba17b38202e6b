"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. ``targets``: the words each source should give. Sources share all words by weight; a target stops at ``cap`` times
   its source's size and the excess is shared again by weight (closed form over sources ordered by size/weight).
2. ``blocks_of``: documents fall into blocks of about ``BLOCK_DOCUMENTS`` by a digest of id and text. A source
   gives whole passes over its blocks and then the blocks up to the rest of its target; the block in which the
   target falls is cut between, and once within, documents.
3. ``shard_quotas``: the exact number of block draws of every source is split among the output shards: each node
   of a binary tree draws its left child's counts from the multivariate hypergeometric distribution.
4. A source's draws are permuted and dealt to the shards by these counts, so shards hold disjoint draws; rows carry a
   digest by which a shard is sorted locally.

Defined results: null texts have no words and null sources are one source, last; sources without words and empty tables
have target 0; identical rows in a cut block share what it gives in whole words; results depend on content
and seed only. The tree handles all sources in one row per node, so the number of sources (not of rows)
must fit in memory: ``MAX_SOURCES`` is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import SPACES, count_words, scratch_folder, stored, text_of

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_DOCUMENTS = 512
SHARD_LEVELS = 4
MAX_SOURCES = 100_000
CHUNK = 1024
#: Primes for the permutation of draws; one that divides the number of draws is passed over.
PRIMES = (999_999_937, 999_999_929, 999_999_893, 999_999_883)


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    """(keep, source, size, key): ``key`` is a digest of id and text that orders documents at random."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_of()))
    return docs.select(*keep, F.col("source").alias("mix_source"), count_words(text_of()).alias("size"), key.alias("key"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(mix_source, documents, source_size, weight, target), one row per source; windows run over sources only."""
    sources = rows.groupBy("mix_source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents")
    )
    by_name = Window.orderBy(F.col("mix_source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place).cast("long"))
    everything = Window.partitionBy()
    before = Window.orderBy(
        (F.col("source_size").cast("double") / F.col("weight")).asc(), F.col("mix_source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    limit = F.col("source_size") * cap
    asked = weighed.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "weights": F.sum("weight").over(everything),
            "limits_before": F.coalesce(F.sum(limit).over(before), F.lit(0)),
            "weights_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    level = (F.col("total") - F.col("limits_before")).cast("double") / (F.col("weights") - F.col("weights_before"))
    capped = asked.withColumn("capped", limit.cast("double") / F.col("weight") <= level)
    left = capped.withColumns(
        {
            "rest": F.col("total") - F.sum(F.when(F.col("capped"), limit).otherwise(0)).over(everything),
            "rest_weights": F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything),
        }
    )
    share = (F.col("rest") * F.col("weight")).cast("double") / F.greatest(F.col("rest_weights"), F.lit(1))
    return left.select(
        "mix_source",
        "documents",
        "source_size",
        "weight",
        F.when(F.col("capped"), limit.cast("double")).otherwise(share).alias("target"),
    )


def running_total(rows: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Adds ``before``, the sum of ``value`` over smaller ``order`` within ``by``; no window holds more than
    ``CHUNK`` consecutive rows, or the sums of so many chunks' worth."""
    chunked = rows.withColumn("chunk", F.floor(F.col(order) / CHUNK))
    sums = chunked.groupBy(by, "chunk").agg(F.sum(value).alias("chunk_sum"))
    earlier = Window.partitionBy(by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col(by).alias("_by"),
        F.col("chunk").alias("_chunk"),
        F.coalesce(F.sum("chunk_sum").over(earlier), F.lit(0)).alias("offset"),
    )
    inside = Window.partitionBy(by, "chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunked.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, F.col(by).eqNullSafe(F.col("_by")) & (F.col("chunk") == F.col("_chunk")))
        .withColumn("before", F.col("inside") + F.col("offset"))
        .drop("chunk", "inside", "offset", "_by", "_chunk")
    )


def block_number(blocks: Column) -> Column:
    return F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), blocks)


# The splitting tree.


def log_factorial(n: Column) -> Column:
    """Stirling's series eight above ``n``, accurate to 1e-12."""
    x = n.cast("double") + 9
    near = F.lit(1.0)
    for step in range(1, 9):
        near = near * (n + step)
    series = (x - 0.5) * F.ln(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x)
    return series - F.ln(near)


def hypergeometric(rest: Column, draws: Column, marked: Column, uniform: Column) -> Column:
    """How many of ``draws`` from ``rest`` items, ``marked`` of them marked, are marked: the inverse distribution
    function at ``uniform``, searched within twelve deviations of the mean."""
    ones = F.greatest(rest, F.lit(1)).cast("double")
    mean = draws.cast("double") * marked / ones
    spread = F.sqrt(mean * (1 - marked / ones) * F.greatest(1 - draws / ones, F.lit(0.0))) * 12 + 2
    low = F.greatest(F.lit(0).cast("long"), draws - (rest - marked), F.floor(mean - spread).cast("long"))
    high = F.least(marked, draws, F.ceil(mean + spread).cast("long"))

    def settled(case: Column) -> Column:
        def log_weight(k: Column) -> Column:
            m, d, r = case["marked"], case["draws"], case["rest"]
            return -(log_factorial(k) + log_factorial(m - k) + log_factorial(d - k) + log_factorial(r - m - d + k))

        logs = F.transform(F.sequence(case["low"], case["high"]), log_weight)
        return F.struct(logs.alias("logs"), F.array_max(logs).alias("top"))

    def chosen(found: Column) -> Column:
        weights = F.transform(found["logs"], lambda x: F.exp(x - found["top"]))
        aim = uniform * F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("passed"))

        def step(acc: Column, x: Column) -> Column:
            total = acc["sum"] + x
            return F.struct(total.alias("sum"), (acc["passed"] + F.when(total < aim, 1).otherwise(0)).alias("passed"))

        return F.aggregate(weights, start, step, lambda acc: acc["passed"])

    case = F.struct(
        low.alias("low"), high.alias("high"), rest.alias("rest"), draws.alias("draws"), marked.alias("marked")
    )
    found = F.transform(F.array(case), settled)
    steps = F.transform(found, chosen)[0]
    return F.least(low + steps, high)


def dealing(seed: int, level: int):
    """Step over the sources of a node: how many draws of one go left, given what the ones before took."""

    def step(acc: Column, source: Column) -> Column:
        dice = F.xxhash64(F.lit(seed), F.lit(level), F.col("shard"), source["mix_source"], F.size(acc["left"]))
        uniform = (F.pmod(dice, F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
        taken = hypergeometric(acc["rest"], acc["room"], source["draws"], uniform)
        return F.struct(
            (acc["rest"] - source["draws"]).alias("rest"),
            (acc["room"] - taken).alias("room"),
            F.concat(acc["left"], F.array(taken)).alias("left"),
        )

    return step


def shard_quotas(quotas: DataFrame, levels: int = SHARD_LEVELS, seed: int = 42) -> DataFrame:
    """(mix_source, shard, quota) from (mix_source, draws): exact, each shard an equal number of draws up to one."""
    entry = F.struct("mix_source", "draws")
    nodes = quotas.agg(F.array_sort(F.collect_list(entry)).alias("sources")).withColumn("shard", F.lit(0))
    for level in range(levels):
        total = F.aggregate("sources", F.lit(0).cast("long"), lambda a, s: a + s["draws"])
        nodes = nodes.withColumn("total", total).withColumn("half", F.floor((F.col("total") + 1) / 2))
        start = F.struct(
            F.col("total").alias("rest"),
            F.col("half").alias("room"),
            F.array().cast("array<bigint>").alias("left"),
        )

        nodes = nodes.withColumn("left", F.aggregate("sources", start, dealing(seed, level), lambda acc: acc["left"]))

        def child(right: bool) -> Column:
            def part(source: Column, taken: Column) -> Column:
                draws = source["draws"] - taken if right else taken
                return F.struct(source["mix_source"].alias("mix_source"), draws.alias("draws"))

            halves = F.zip_with("sources", "left", part)
            return F.struct((F.col("shard") * 2 + int(right)).alias("shard"), halves.alias("sources"))

        nodes = nodes.select(F.inline(F.array(child(False), child(True))))
    return nodes.select("shard", F.inline("sources")).select("mix_source", "shard", F.col("draws").alias("quota"))


def draws(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, levels: int = SHARD_LEVELS) -> tuple:
    """The mix's plan as two small tables: per source its target, passes and shard bounds; per block of the last,
    partial pass its place. A third holds the words given by the documents of the blocks cut."""
    folder = scratch_folder(rows.sparkSession, "mix")
    wanted = F.floor(F.col("target") + 0.5).cast("long")
    passes = F.floor(wanted / F.greatest(F.col("source_size"), F.lit(1)))
    sources = stored(
        targets(rows, weights, cap).withColumns(
            {
                "blocks": F.ceil(F.col("documents") / BLOCK_DOCUMENTS).cast("long"),
                "passes": passes.cast("long"),
                "rest": wanted - passes * F.col("source_size"),
            }
        ),
        f"{folder}/sources",
    )
    if sources.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    plan = sources.select(F.col("mix_source").alias("_source"), "blocks", F.col("rest").alias("_rest"))
    placed = rows.join(plan, F.col("mix_source").eqNullSafe(F.col("_source"))).withColumn(
        "block", block_number(F.col("blocks"))
    )
    sums = placed.groupBy("mix_source", "block", "_rest").agg(F.sum("size").alias("words"))
    blocks = stored(
        running_total(sums, "mix_source", "block", "words")
        .where(F.col("before") < F.col("_rest"))
        .select(
            F.col("mix_source").alias("_source"),
            F.col("block").alias("_block"),
            (F.col("_rest") - F.col("before")).alias("room"),
            "words",
        ),
        f"{folder}/blocks",
    )
    cut = blocks.where(F.col("room") < F.col("words")).select("_source", "_block", "room")
    same = F.col("mix_source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    members = (
        placed.drop("_source")
        .join(cut, same)
        .groupBy("mix_source", "block", "key", "size", "room")
        .agg(F.count("*").alias("copies"))
    )
    earlier = Window.partitionBy("mix_source", "block").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.col("size") * F.col("copies")
    open_room = F.col("room") - F.coalesce(F.sum(weight).over(earlier), F.lit(0))
    partial = stored(
        members.select(
            F.col("key").alias("_key"),
            F.floor(F.greatest(F.lit(0), F.least(open_room, weight)) / F.col("copies")).cast("long").alias("part"),
        ).where("part > 0"),
        f"{folder}/partial",
    )
    last = blocks.groupBy("_source").agg(F.count("*").alias("last_blocks"))
    counted = sources.join(last, F.col("mix_source").eqNullSafe(F.col("_source")), "left").select(
        "mix_source", (F.col("passes") * F.col("blocks") + F.coalesce("last_blocks", F.lit(0))).alias("draws")
    )
    bounds = (
        shard_quotas(counted, levels)
        .groupBy("mix_source")
        .agg(F.array_sort(F.collect_list(F.struct("shard", "quota"))).alias("quotas"), F.sum("quota").alias("draws"))
        .select(F.col("mix_source").alias("_bound_source"), F.col("quotas.quota").alias("quotas"), "draws")
    )
    table = stored(
        sources.join(bounds, F.col("mix_source").eqNullSafe(F.col("_bound_source")), "left")
        .withColumn("step", stride(F.col("draws")))
        .select(
            F.col("mix_source").alias("_source"),
            *["blocks", "source_size", "target", "passes", "quotas", "step"],
            F.col("draws").alias("n_draws"),
        ),
        f"{folder}/plan",
    )
    return table, blocks.select("_source", "_block", (F.col("room") < F.col("words")).alias("is_cut")), partial


def stride(draws: Column) -> Column:
    """A prime that does not divide ``draws``; multiplying by it permutes 0 .. draws-1."""
    chosen = F.lit(PRIMES[-1])
    for prime in PRIMES[:-1][::-1]:
        chosen = F.when(draws % prime != 0, F.lit(prime)).otherwise(chosen)
    return chosen.cast("long")


def mix(rows: DataFrame, plan: tuple) -> DataFrame:
    """``rows`` (from ``sized``) with ``source_size``, ``target`` and ``draws``: an array of (copy, words, shard,
    place), one entry for every time the document is drawn, at most one more than ``cap``."""
    table, last, partial = plan
    at_block = F.col("block") == F.col("_block")
    names = [c for c in rows.columns]
    joined = (
        rows.join(table, F.col("mix_source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("block", block_number(F.col("blocks")))
    )
    joined = joined.join(last, F.col("mix_source").eqNullSafe(F.col("_source")) & at_block, "left").drop("_source")
    joined = joined.join(partial, F.col("key") == F.col("_key"), "left")
    rest = F.when(F.col("is_cut"), F.coalesce("part", F.lit(0))).when(F.col("is_cut").isNotNull(), F.col("size"))

    def drawn(copy: Column) -> Column:
        index = (copy - 1) * F.col("blocks") + F.col("block")
        count = F.greatest(F.col("n_draws"), F.lit(1))
        at = F.pmod(F.pmod(index, count) * F.pmod(F.col("step"), count), count)
        state = F.struct(F.lit(0).alias("shard"), F.lit(0).cast("long").alias("end"))

        def step(acc: Column, quota: Column) -> Column:
            end = acc["end"] + quota
            return F.struct((acc["shard"] + F.when(end <= at, 1).otherwise(0)).alias("shard"), end.alias("end"))

        words = F.when(copy <= F.col("passes"), F.col("size")).otherwise(F.coalesce(rest, F.lit(0)))
        return F.struct(
            copy.alias("copy"),
            words.alias("words"),
            F.aggregate("quotas", state, step, lambda acc: acc["shard"]).alias("shard"),
            F.md5(F.concat_ws(":", copy.cast("string"), F.col("key"))).alias("place"),
        )

    every = F.transform(F.sequence(F.lit(1).cast("long"), F.col("passes") + 1), drawn)
    return joined.select(
        *names, "source_size", "target", F.filter(every, lambda d: d["words"] > 0).alias("draws")
    )


def materialised(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every draw as a row with the columns of ``docs``, in local random order per shard.

    A document drawn in part appears with its leading words. ``n_chars`` follows the text.
    """
    plan = draws(stored(sized(docs), scratch_folder(docs.sparkSession, "mix-sizes")), **options)
    hidden = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}
    key = sized(docs, *[F.col(f"`{c}`").alias(h) for c, h in hidden.items()])
    rows = mix(key, plan).select(*hidden.values(), "size", F.explode("draws").alias("draw"))
    text = F.col(hidden["text"])
    # pieces are words with the blanks after them; blanks before the first word are a piece of their own
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?![\x20\x09-\x0D])", -1)
    lead = F.when(F.btrim(pieces[0], F.lit(SPACES)) == "", 1).otherwise(0)
    leading = F.array_join(F.slice(pieces, F.lit(1), (F.col("draw.words") + lead).cast("int")), "")
    shown = F.when(F.col("draw.words") < F.col("size"), leading).otherwise(text)
    made = {"text": shown, "n_chars": F.length(shown).cast("long")}
    # a shard's draws are dealt over many tasks by their place, then put in order there
    part = F.substring("draw.place", 1, 2)
    rows = rows.repartition("draw.shard", part).sortWithinPartitions("draw.shard", "draw.place")
    return rows.select(
        *[made[c].alias(c) if c in made else F.col(h).alias(c) for c, h in hidden.items()]
    )
