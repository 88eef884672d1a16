"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of a source fall into blocks by a hash. The mix draws whole blocks: every full pass over a source
draws all of them in a new permuted order, and a last partial pass draws them until the source's target is
met. The numbers of draws per source are exact quotas; a binary tree over the output shards splits them,
each node by one multivariate hypergeometric draw, so every shard gets its share of blocks and no block
is drawn twice. The documents of a shard are then shuffled in the shard.

Each task walks the tree from the root to its own shards with generators seeded by the node, so reruns
agree and no table of shards times sources exists anywhere. What every task holds is one number per
source. The last block of a partial pass is filled document by document, in local shuffle order, with
what still fits.

Defined cases: null or wordless texts have size 0; null is a source of its own, the last one; rows with one
id (null ids too) go together; a source of size 0 has target 0; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.scratch import written

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
BLOCK_DOCS = 64
# More blocks per source would only make the plan larger, not finer where it matters.
MOST_BLOCKS = 1 << 16
SEED = 20_251
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: str | Column) -> Column:
    """Words of a text between white space, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """``source, rank, n_docs, source_size, target`` from ``source, n_docs, source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes. With
    sources in order of the price at which their cap binds, the common price is the highest of those that
    hold when all cheaper ones are capped; that is where resharing the excess ends.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("rank") % len(weights) + 1)
    cap = F.col("source_size") * most
    priced = ranked.select("*", weight.alias("w"), cap.alias("cap"))
    cheaper = Window.orderBy(F.col("cap") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(cheaper), F.lit(0))
    weights_left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(cheaper), F.lit(0))
    price = priced.withColumn("price", left / weights_left)
    best = F.max("price").over(everything)
    target = F.least(F.col("cap").cast("double"), F.col("w") * best)
    return price.withColumn("target", target).select("source", "rank", "n_docs", "source_size", "target")


def _node_seed(seed: int, low: int, high: int) -> np.random.Generator:
    return np.random.default_rng([seed, low, high])


def shard_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Per source, the first draw of a shard and how many it has: a walk down the splitting tree."""
    quotas = np.asarray(quotas, np.int64)
    total = int(quotas.sum())
    first, low, high = np.zeros_like(quotas), 0, shards
    held = quotas
    while high - low > 1:
        middle = (low + high) // 2
        share = total * middle // shards - total * low // shards
        left = split_quota(held, share, _node_seed(seed, low, high))
        if shard < middle:
            held, high = left, middle
        else:
            first, held, low = first + left, held - left, middle
    return first, held


def split_quota(held: np.ndarray, share: int, random: np.random.Generator) -> np.ndarray:
    """A multivariate hypergeometric draw of ``share`` out of ``held``, one source after the other.

    A source's conditional draw is hypergeometric.
    """
    out, rest = np.zeros_like(held), int(held.sum())
    for i, n in enumerate(held.tolist()):
        rest -= n
        out[i] = _hypergeometric(n, rest, share, random)
        share -= int(out[i])
    return out


def _hypergeometric(good: int, bad: int, n: int, random: np.random.Generator, limit: int = 10**9) -> int:
    if good + bad < limit:
        return int(random.hypergeometric(good, bad, n)) if n else 0
    got, population = 0, good + bad
    for _ in range(good):  # beyond the generator's range: is this block among the drawn?
        hit = random.random() * population < n
        got, n, population = got + hit, n - hit, population - 1
    return got


def _fill(need_of: str):
    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["place", "key"])
        left, chosen = float(group[need_of].iloc[0]), []
        for key, size in zip(group["key"].tolist(), group["size"].tolist()):
            if size <= left:
                chosen.append(key)
                left -= size
        return pd.DataFrame({"rank": [int(group["rank"].iloc[0])], "block": [int(group["block"].iloc[0])], "chosen": [chosen]})

    return choose


def _keyed(docs: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Documents (``doc_id, source, size`` and more) with their source's columns, block and key."""
    key = F.xxhash64(F.lit(seed), "doc_id")
    joined = docs.withColumnRenamed("source", "own").join(sources, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    return joined.withColumn("key", key).withColumn("block", F.pmod("key", "n_blocks").cast("int"))


def mixing_plan(docs: DataFrame, *, shards: int, seed: int = SEED, weights=WEIGHTS, most: int = MOST_TIMES, block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and per drawn block where it goes.

    ``docs`` has ``doc_id, source, size``. The second table has ``rank, block, draws, chosen``: ``draws``
    lists ``shard, pass, partial`` and ``chosen`` the keys of documents that a partial draw takes.
    """
    spark = docs.sparkSession
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    n_blocks = F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("n_docs") / block_docs)).cast("int")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    sources = written(
        source_targets(sizes, weights, most).select("*", n_blocks.alias("n_blocks"), passes.alias("passes"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")),
        "sources",
    )
    keyed = _keyed(docs, sources, seed)
    by_block = keyed.groupBy("rank", "block", "passes", "rest").agg(F.sum("size").alias("words"))
    order = F.xxhash64(F.lit(seed), "rank", "pass", "block")
    along = Window.partitionBy("rank", "pass").orderBy(order, "block")
    all_passes = by_block.select("*", F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("pass"))
    cut = all_passes.select(
        "*", (F.row_number().over(along) - 1).alias("place"),
        (F.sum("words").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")).alias("before"),
        F.count(F.lit(1)).over(Window.partitionBy("rank", "pass")).alias("blocks"),
    )
    last = F.col("pass") == F.col("passes")
    drawn = cut.where(~last | (F.col("before") < F.col("rest"))).select(
        "rank", "block", "pass", (F.col("pass") * F.col("blocks") + F.col("place")).alias("draw"),
        (last & (F.col("before") + F.col("words") > F.col("rest"))).alias("partial"),
        (F.col("rest") - F.col("before")).alias("need"),
    )
    drawn = written(drawn, "draws")
    held = dict(drawn.groupBy("rank").count().collect())  # a number per source
    quotas = np.array([held.get(i, 0) for i in range(max(held, default=-1) + 1)], np.int64)
    shared = spark.sparkContext.broadcast(quotas)

    def walk(frames):
        for frame in frames:
            for shard in frame["id"]:
                first, n = shard_quotas(shared.value, shards, int(shard), seed)
                own = np.flatnonzero(n)
                yield pd.DataFrame({"shard": np.full(len(own), shard, np.int32), "rank": own.astype(np.int32), "first": first[own], "n": n[own]})

    dealt = spark.range(shards).mapInPandas(walk, "shard int, rank int, first bigint, n bigint")
    dealt = dealt.select("shard", "rank", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("draw"))
    draws = drawn.join(dealt, ["rank", "draw"]).groupBy("rank", "block").agg(
        F.array_sort(F.collect_list(F.struct("shard", "pass", "partial"))).alias("draws")
    )
    edges = drawn.where("partial").select("rank", "block", "need")
    place = F.xxhash64(F.lit(seed + 1), "key").alias("place")
    edge_docs = keyed.join(edges, ["rank", "block"]).groupBy("rank", "block", "key", "need").agg(F.sum("size").alias("size")).select("*", place)
    chosen = edge_docs.groupBy("rank", "block").applyInPandas(_fill("need"), "rank int, block int, chosen array<bigint>")
    plan = draws.join(chosen, ["rank", "block"], "left")
    return sources, written(plan, "mixing-plan")


def _takes(docs: DataFrame, sources: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Documents with ``takes``, an entry ``shard, pass`` for each time the mix takes them."""
    joined = _keyed(docs, sources, seed).join(plan, ["rank", "block"], "left")
    kept = F.filter("draws", lambda d: ~d["partial"] | F.coalesce(F.array_contains("chosen", F.col("key")), F.lit(False)))
    none = F.array().cast("array<struct<shard:int,pass:int,partial:boolean>>")
    return joined.withColumn("takes", F.coalesce(kept, none))


def mixed_sizes(docs: DataFrame, *, doc_id="doc_id", text="text", source="source", shards: int | None = None, seed: int = SEED, **options) -> DataFrame:
    """Per document ``doc_id, size, source_size, target, taken, takes``."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words_in(F.col(text)).alias("size")), "sizes")
    sources, plan = mixing_plan(sized, shards=shards, seed=seed, **options)
    taken = F.size("takes") * F.col("size")
    return _takes(sized, sources, plan, seed).select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"), "takes")


def mixed_documents(docs: DataFrame, *, doc_id="doc_id", text="text", source="source", shards: int | None = None, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: a row for each time a document is taken, with all its columns.

    Rows lie shard by shard, in each shard in a shuffled order.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"), words_in(F.col(f"`{text}`")).alias("size"),
    )
    sized = written(base.select("doc_id", "source", "size"), "sizes")
    sources, plan = mixing_plan(sized, shards=shards, seed=seed, **options)
    placed = _takes(base, sources, plan, seed).select("row", "key", F.explode("takes").alias("take"))
    local = F.xxhash64(F.lit(seed + 2), "take.pass", "key")
    dealt = placed.select("row", F.col("take.shard").alias("shard"), local.alias("place")).repartition(shards, "shard")
    return dealt.sortWithinPartitions("shard", "place").select("row.*")
