"""Feature vectors of headwords, capacity-bound clustering and classification to clusters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut
from .lexicon import ranked

# Decay along lists of relations, and the weight each group starts with.
DECAY = 0.95
GROUP_WEIGHTS = (("word", 1.0), ("parent", 0.8), ("child", 0.6), ("translation", 0.5))


def word_features(relations: DataFrame, top: int = 128) -> DataFrame:
    """key, label, weight: the best `top` labels of each word; relations: key, kind, place (from 0), label.

    A label's weight falls along its list; of several lists the best counts; a word's weights are relative to its greatest.
    """
    start = F.coalesce(*(F.when(F.col("kind") == kind, weight) for kind, weight in GROUP_WEIGHTS), F.lit(0.3))
    each = relations.select("key", "label", (start * F.pow(F.lit(DECAY), F.col("place").cast("double"))).alias("w"))
    best = each.groupBy("key", "label").agg(F.max(F.round("w", 9)).alias("w"))
    part = Window.partitionBy("key")
    ranked = best.withColumn("r", F.row_number().over(part.orderBy(F.desc("w"), "label"))).withColumn("m", F.max("w").over(part))
    return ranked.where(F.col("r") <= top).select("key", "label", (F.col("w") / F.col("m")).alias("weight"))


def spread_features(features: DataFrame, edges: DataFrame, share: float = 0.3) -> DataFrame:
    """Adds to each word a share of its neighbours' features: key, label, weight. edges: key, other."""
    lent = edges.join(features.withColumnRenamed("key", "other"), "other").select("key", "label", (F.col("weight") * share).alias("weight"))
    return features.unionByName(lent).groupBy("key", "label").agg(F.sum(F.round("weight", 9)).alias("weight"))


def prune_features(features: DataFrame, keep: int, ideal: float, least_docs: int = 2) -> DataFrame:
    """The `keep` best labels of each word; labels near the ideal document frequency are preferred, very rare ones dropped."""
    docs = features.groupBy("label").agg(F.count("*").alias("docs")).where(F.col("docs") >= least_docs)
    fit = 1 / (F.abs(F.log(F.col("docs") / F.lit(ideal))) + 1)
    scored = features.join(docs, "label").withColumn("s", F.round(F.col("weight") * fit, 9))
    return scored.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("s"), "label"))).where(F.col("r") <= keep).select("key", "label", "weight")


def cluster_scores(items: DataFrame, centres: DataFrame) -> DataFrame:
    """key, cluster, score: sparse dot products of items and centres over their lengths."""
    length = lambda df, by: df.groupBy(by).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias(f"{by}_n"))
    dot = items.withColumnRenamed("weight", "a").join(centres.withColumnRenamed("weight", "b"), "label").groupBy("key", "cluster").agg(F.sum(F.col("a") * F.col("b")).alias("dot"))
    return dot.join(length(items, "key"), "key").join(length(centres, "cluster"), "cluster").select("key", "cluster", (F.col("dot") / (F.col("key_n") * F.col("cluster_n"))).alias("score"))


def assign(scores: DataFrame, capacity: int, items: DataFrame | None = None, clusters: DataFrame | None = None) -> DataFrame:
    """key, cluster: each item in its best cluster that has room, the better item first.

    Deferred acceptance: in each round all items without a place ask their best cluster that has not refused them, and each
    cluster keeps its `capacity` best; a round is one window, so no task holds more than a cluster's askers. A full cluster
    refuses all offers below its worst member at once, for its members only get better; rounds go on until none is refused.
    `items` (key) and `clusters` (cluster) name all there are, by default those of the scores. A pair without a score counts 0:
    items that are left fill the free places, by key and cluster. Only if there are fewer places than items, cluster is null.
    """
    open_offers = cut(scores.select("key", "cluster", F.round("score", 9).alias("score")))
    keys = (scores if items is None else items).select("key").distinct()
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "cluster"))
    place = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("score"), "key"))
    while True:
        judged = cut(open_offers.withColumn("r", first).where("r = 1").withColumn("p", place).select("key", "cluster", "score", "p"))
        if judged.where(F.col("p") > capacity).isEmpty():
            break
        worst = judged.where(F.col("p") == capacity).select("cluster", F.col("score").alias("bar"), F.col("key").alias("last"))
        kept = F.col("bar").isNull() | (F.col("score") > F.col("bar")) | ((F.col("score") == F.col("bar")) & (F.col("key") <= F.col("last")))
        open_offers = cut(open_offers.join(worst, "cluster", "left").where(kept).select("key", "cluster", "score"))
    placed = judged.select("key", "cluster")
    left = cut(keys.join(placed, "key", "left_anti"))
    if left.isEmpty():
        return keys.join(placed, "key", "left")
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("n"))
    room = (scores if clusters is None else clusters).select("cluster").distinct().join(sizes, "cluster", "left").select("cluster", (F.lit(capacity) - F.coalesce("n", F.lit(0))).alias("room"))
    before = F.sum("room").over(Window.orderBy("cluster").rowsBetween(Window.unboundedPreceding, 0)) - F.col("room")
    slots = room.where("room > 0").withColumn("before", before).select("cluster", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("room"))).alias("rank"))
    filled = ranked(left.withColumn("score", F.lit(0.0))).join(slots, "rank").select("key", "cluster")
    return keys.join(placed.unionByName(filled), "key", "left")


def seed_centres(features: DataFrame, count: int, candidates: int = 4) -> DataFrame:
    """cluster, label, weight: of the heaviest `candidates` x `count` items, farthest first, `count` seeds.

    The items looked at are bounded by the parameters, so they are chosen from in one task.
    """
    mass = features.groupBy("key").agg(F.sum(F.round("weight", 9)).alias("m")).orderBy(F.desc("m"), "key").limit(candidates * count)
    pool = features.join(mass, "key").select("key", "label", "weight", "m")

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = {k: dict(zip(g["label"], g["weight"])) for k, g in frame.groupby("key", sort=True)}
        order = frame.groupby("key")["m"].first().sort_index().sort_values(ascending=False, kind="stable").index.tolist()
        chosen, summed = [], {}
        while order and len(chosen) < count:
            norm = sum(w * w for w in summed.values()) ** 0.5 or 1.0
            likeness = [sum(w * summed.get(x, 0.0) for x, w in vectors[k].items()) / norm for k in order]
            at = min(range(len(order)), key=lambda i: (likeness[i], i))
            name = order.pop(at)
            chosen.append(name)
            for x, w in vectors[name].items():
                summed[x] = summed.get(x, 0.0) + w
        rows = [(n, x, w) for n, k in enumerate(chosen) for x, w in vectors[k].items()]
        return pd.DataFrame(rows, columns=["cluster", "label", "weight"])

    return pool.groupBy(F.lit(0).alias("all")).applyInPandas(choose, "cluster int, label string, weight double")


def cluster(features: DataFrame, count: int, rounds: int = 3, top: int = 160, items: DataFrame | None = None) -> DataFrame:
    """key, cluster: rounds of capacity-bound assignment to centres that move with a momentum of 0.2.

    `items` (key) names all words to place, also those without features; by default those of the features.
    """
    features = cut(features)
    items = cut((features if items is None else items).select("key").distinct())
    n = items.count()
    capacity = -(-n // count)
    centres = cut(seed_centres(features, count))
    members = None
    for _ in range(rounds):
        scores = cut(cluster_scores(features, centres))
        members = cut(assign(scores, capacity, items, centres))
        weighed = members.where("cluster is not null").join(scores, ["key", "cluster"]).join(features, "key")
        moved = weighed.groupBy("cluster", "label").agg(F.sum(F.round(F.col("weight") * (F.col("score") + 0.1), 9)).alias("weight"))
        greatest = Window.partitionBy("cluster")
        moved = moved.withColumn("weight", F.col("weight") / F.max("weight").over(greatest))
        both = moved.unionByName(centres.withColumn("weight", F.col("weight") * 0.2)).groupBy("cluster", "label").agg(F.sum(F.round("weight", 9)).alias("weight"))
        centres = cut(both.withColumn("r", F.row_number().over(greatest.orderBy(F.desc("weight"), "label"))).where(F.col("r") <= top).drop("r"))
    return members


def classify(members: DataFrame, features: DataFrame, quota: int = 15, top: int = 128, items: DataFrame | None = None) -> DataFrame:
    """key, cluster of words without one: the nearest cluster that has room for it, up to `quota` each.

    `items` (key) names the words to place, also those without features; by default those of the features.
    """
    placed = members.where("cluster is not null")
    summed = placed.join(features, "key").groupBy("cluster", "label").agg(F.sum(F.round("weight", 9)).alias("weight"))
    centres = summed.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("weight"), "label"))).where(F.col("r") <= top).drop("r")
    new = features.join(placed.select("key"), "key", "left_anti")
    return assign(cluster_scores(new, centres), quota, new if items is None else items, placed)
