"""Frequent itemsets and association rules over baskets."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.scoring import LAST_SCORE_HIGH, LAST_SCORE_LOW
from sightline.session import cut

# Items in a set at most, unless asked for otherwise; the usual default of rule miners.
MOST_ITEMS = 10
# Baskets and bits of one block, and stems counted in a block by one call.
BLOCK_BASKETS, BLOCK_BITS = 1 << 16, 1 << 25
STEMS_AT_ONCE = 2_000


@dataclass(frozen=True)
class RuleSettings:
    support: float
    confidence: float
    min_length: int = 2
    consequents: tuple[str, ...] = ()
    max_length: int = MOST_ITEMS
    # Whether baskets hold many items, which decides on the miner.
    wide: bool = False


# Thresholds of the mining runs and the consequents they allow.
THREAT_CONSEQUENTS = (
    "low_threat_1",
    "low_threat_2",
    "low_threat_3",
    "mid_threat_4",
    "mid_threat_6",
    "high_threat_7",
    "high_threat_8",
)
SETTINGS = {
    "default": RuleSettings(0.1, 0.8, 1),
    "broad": RuleSettings(0.10, 0.80, 2),
    "threat": RuleSettings(0.000005, 0.6, 2, THREAT_CONSEQUENTS),
    "last_score": RuleSettings(0.0001, 0.7, 2, (LAST_SCORE_HIGH, LAST_SCORE_LOW), wide=True),
    "last_score_common": RuleSettings(0.01, 0.7, 2, (LAST_SCORE_HIGH, LAST_SCORE_LOW), wide=True),
}


def distinct_baskets(baskets: DataFrame) -> DataFrame:
    """(items, w): each set of items once, sorted, with the number of baskets that are it.

    Counted before the shuffle, so of categorical baskets only the few distinct
    ones move. A null list is an empty basket; null and repeated items do not count.
    """
    empty = F.array().cast("array<string>")
    items = F.array_sort(F.array_distinct(F.array_compact(F.coalesce("items", empty))))
    return baskets.select(items.alias("items")).groupBy("items").agg(F.count("*").alias("w"))


def _bit_blocks(names: list[str]):
    """Baskets to rows of ``bits``: for each item, one bit per basket of the block."""

    def pack(batches):
        waiting: list[list[str]] = []
        # An item takes an eighth of a byte per basket, a block some megabytes.
        size = max(64, min(BLOCK_BASKETS, BLOCK_BITS // len(names) // 64 * 64))
        places = {name: i for i, name in enumerate(names)}

        def block(rows):
            flags = np.zeros((len(names), size), dtype=bool)
            for at, items in enumerate(rows):
                flags[[places[i] for i in items or () if i in places], at] = True
            return pa.RecordBatch.from_pydict({"bits": [np.packbits(flags, axis=1).tobytes()]})

        for batch in batches:
            waiting += batch.column("items").to_pylist()
            while len(waiting) >= size:
                yield block(waiting[:size])
                waiting = waiting[size:]
        if waiting:
            yield block(waiting)

    return pack


def _count_in_blocks(n_items: int):
    """Rows (bits, group) to rows (stem, counts): baskets of the block with the stem and each later item."""

    def count(batches):
        for batch in batches:
            for bits, group in zip(batch.column("bits"), batch.column("group").to_pylist()):
                flags = np.frombuffer(bits.as_buffer(), dtype=np.uint64).reshape(n_items, -1)
                counts = [
                    np.bitwise_count(flags[g["later"]] & np.bitwise_and.reduce(flags[g["stem"]], axis=0))
                    .sum(axis=1, dtype=np.int64)
                    .tolist()
                    for g in group
                ]
                stems = pa.array([g["stem"] for g in group], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([stems, pa.array(counts, pa.list_(pa.int64()))], ["stem", "counts"])

    return count


def grown_itemsets(baskets: DataFrame, support: float, max_length: int = MOST_ITEMS) -> DataFrame:
    """The same as ``frequent_itemsets``, for wide baskets with long frequent sets.

    Their subsets are too many to write out basket by basket. Blocks of baskets
    hold one bit per basket and frequent item; a level extends each frequent set
    by the last items of those that share all but its last, and a block counts
    an extension by the bits that both have. Counts are summed over the blocks.
    The frequent items, at most the mean basket size over the support, reach the driver.
    """
    baskets = cut(baskets.select(F.array_distinct(F.array_compact("items")).alias("items")))
    least = max(1, math.ceil(support * baskets.count()))
    single = baskets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    single = cut(single.where(F.col("n") >= least))
    names = sorted(row["item"] for row in single.select("item").collect())
    levels = [single.select(F.array("item").alias("items"), "n")]
    if len(names) < 2:
        return levels[0]
    blocks = cut(baskets.mapInArrow(_bit_blocks(names), "bits binary"))
    blocks = blocks.withColumn("block", F.monotonically_increasing_id())
    spark = baskets.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = spark.range(len(names)).select(F.array(F.col("id").cast("int")).alias("set"))
    label = F.array(*[F.lit(n) for n in names])
    for _ in range(1, max_length):
        last = F.element_at("set", -1)
        stems = sets.groupBy(F.slice("set", 1, F.size("set") - 1).alias("start")).agg(
            F.sort_array(F.collect_list(last)).alias("ends")
        )
        grown = F.transform(
            "ends",
            lambda x, i: F.struct(
                F.concat("start", F.array(x)).alias("stem"), F.slice("ends", i + 2, F.size("ends")).alias("later")
            ),
        )
        stems = cut(stems.select(F.inline(grown)).where(F.size("later") > 0))
        n = stems.count()
        if not n:
            break
        part = F.pmod(F.xxhash64("stem"), F.lit(math.ceil(n / STEMS_AT_ONCE)))
        groups = cut(stems.groupBy(part.alias("part")).agg(F.collect_list(F.struct("stem", "later")).alias("group")))
        tasks = blocks.crossJoin(groups).repartition(width, "block", "part").select("bits", "group")
        counted = tasks.mapInArrow(_count_in_blocks(len(names)), "stem array<int>, counts array<bigint>")
        # Positions of the counts are those of the later items.
        sums = counted.select("stem", F.posexplode("counts").alias("at", "n")).groupBy("stem", "at").agg(
            F.sum("n").alias("n")
        )
        sums = sums.where(F.col("n") >= least).join(stems, "stem")
        found = cut(sums.select(F.concat("stem", F.array(F.get("later", F.col("at")))).alias("set"), "n"))
        levels.append(found.select(F.transform("set", lambda i: F.get(label, i)).alias("items"), "n"))
        sets = found.select("set")
    return union(levels)


def frequent_itemsets(baskets: DataFrame, support: float, max_length: int = MOST_ITEMS) -> DataFrame:
    """Itemsets of at most ``max_length`` items with their counts; items inside a set are sorted.

    Level by level over the distinct baskets: a frequent set meets, in each basket
    that holds it, the later items of that basket, and counts are summed by set.
    Items and then sets that are not frequent leave before the next level. For
    baskets of few items or sets of small length; see ``grown_itemsets`` for others.
    """
    counted = cut(distinct_baskets(baskets))
    total = counted.agg(F.sum("w")).first()[0] or 0
    least = max(1, math.ceil(support * total))
    single = counted.select(F.explode("items").alias("item"), "w").groupBy("item").agg(F.sum("w").alias("n"))
    single = cut(single.where(F.col("n") >= least))
    numbered = counted.select("items", "w", F.monotonically_increasing_id().alias("id"))
    met = cut(numbered).select("id", "w", F.explode("items").alias("item")).join(single.select("item"), "item")
    kept = met.groupBy("id", "w").agg(F.array_sort(F.collect_list("item")).alias("rest"))
    # Without rare items, more baskets are equal.
    kept = kept.groupBy("rest").agg(F.sum("w").alias("w"))
    held = cut(kept.select(F.array().cast("array<string>").alias("items"), "rest", "w"))
    levels = [single.select(F.array("item").alias("items"), "n")]
    for length in range(1, max_length):
        longer = F.transform(
            "rest",
            lambda x, i: F.struct(
                F.concat("items", F.array(x)).alias("items"), F.slice("rest", i + 2, F.size("rest")).alias("rest")
            ),
        )
        found = held.select("w", F.inline(longer))
        # A set that ends its basket counts at this level but has no longer ones.
        if length == 1 and max_length == 2:
            # Nothing grows from here: pairs are counted as they are, without their rests.
            held = found.where(F.size("rest") > 0)
            continue
        if length == 1:
            held = cut(found.where(F.size("rest") > 0).groupBy("items", "rest").agg(F.sum("w").alias("w")))
            continue
        sums = cut(found.groupBy("items").agg(F.sum("w").alias("n")).where(F.col("n") >= least))
        if sums.isEmpty():
            return union(levels)
        levels.append(sums)
        held = cut(found.where(F.size("rest") > 0).join(sums.select("items"), "items", "left_semi"))
    if max_length > 1:
        found = held.select("w", F.explode(F.transform("rest", lambda x: F.concat("items", F.array(x)))).alias("items"))
        levels.append(found.groupBy("items").agg(F.sum("w").alias("n")).where(F.col("n") >= least))
    return union(levels)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def mine(baskets: DataFrame, settings: RuleSettings) -> DataFrame:
    """Rules (antecedent, consequent, confidence, lift, support) with one consequent each.

    A single item is a rule from the empty antecedent, with its share as
    confidence; a minimum length of two leaves these out.
    """
    miner = grown_itemsets if settings.wide else frequent_itemsets
    sets = cut(miner(baskets, settings.support, settings.max_length))
    total = baskets.agg(F.count("*").alias("n")).scalar()
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("c"), F.col("n").alias("n_rhs"))
    sided = sets.where(F.size("items") >= settings.min_length).select("items", "n", F.explode("items").alias("c"))
    if settings.consequents:
        sided = sided.where(F.col("c").isin(*settings.consequents))
    sided = sided.withColumn("antecedent", F.array_remove("items", F.col("c")))
    lhs = sets.select(F.col("items").alias("antecedent"), F.col("n").alias("n_lhs"))
    met = sided.join(single, "c").join(lhs, "antecedent", "left")
    confidence = F.col("n") / F.when(F.size("antecedent") == 0, total).otherwise(F.col("n_lhs"))
    rules = met.select(
        "antecedent",
        F.array("c").alias("consequent"),
        confidence.alias("confidence"),
        (confidence / (F.col("n_rhs") / total)).alias("lift"),
        (F.col("n") / total).alias("support"),
    )
    return rules.where(F.col("confidence") >= settings.confidence)


def one_item_rules(baskets: DataFrame, consequents: tuple[str, ...]) -> DataFrame:
    """All rules from one item to one of a few, at any support.

    Counting (item, consequent) pairs needs one aggregate per side, so the
    lowest thresholds cost no more than high ones.
    """
    wanted = F.array(*[F.lit(c) for c in consequents])
    kept = baskets.select("items", F.array_intersect("items", wanted).alias("rhs"))
    total = baskets.agg(F.count("*").alias("n")).scalar()
    single = kept.select(F.explode("items").alias("item")).groupBy("item").agg(
        F.count("*").alias("n")
    )
    pairs = (
        kept.where(F.size("rhs") > 0)
        .select(F.explode("items").alias("antecedent"), "rhs")
        .select("antecedent", F.explode("rhs").alias("consequent"))
        .where(F.col("antecedent") != F.col("consequent"))
        .groupBy("antecedent", "consequent")
        .agg(F.count("*").alias("n_both"))
    )
    lhs = single.select(F.col("item").alias("antecedent"), F.col("n").alias("n_lhs"))
    rhs = single.select(F.col("item").alias("consequent"), F.col("n").alias("n_rhs"))
    confidence = F.col("n_both") / F.col("n_lhs")
    return (
        pairs.join(lhs, "antecedent")
        .join(rhs, "consequent")
        .select(
            "antecedent",
            "consequent",
            (F.col("n_both") / total).alias("support"),
            confidence.alias("confidence"),
            (confidence / (F.col("n_rhs") / total)).alias("lift"),
        )
    )


def with_item(rules: DataFrame, item: str) -> DataFrame:
    """Rules that have the item on either side."""
    return rules.where(
        F.array_contains("antecedent", item) | F.array_contains("consequent", item)
    )


def confident(rules: DataFrame, above: float = 0.8) -> DataFrame:
    return rules.where(F.col("confidence") > above)


def by_lift(rules: DataFrame, first: int = 1, last: int = 10) -> DataFrame:
    """Ranks ``first`` to ``last`` of the rules sorted by lift; ties by the rule itself."""
    order = [F.col("lift").desc(), "antecedent", "consequent"]
    return rules.orderBy(*order).limit(last).orderBy(*order).offset(first - 1)


def summary(rules: DataFrame) -> DataFrame:
    """Number of rules and quartiles of each quality measure, one row per measure."""
    quality = rules.unpivot([], ["support", "confidence", "lift"], "measure", "value")
    weighted = quality.groupBy("measure", "value").agg(F.count("*").alias("w"))
    points = F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])
    q = F.percentile("value", points, F.col("w"))
    return weighted.groupBy("measure").agg(
        F.sum("w").alias("rules"),
        F.min("value").alias("min"),
        q[0].alias("p25"),
        q[1].alias("p50"),
        q[2].alias("p75"),
        F.max("value").alias("max"),
    )


def lengths(rules: DataFrame) -> DataFrame:
    return rules.groupBy((F.size("antecedent") + 1).alias("length")).agg(
        F.count("*").alias("n")
    )
