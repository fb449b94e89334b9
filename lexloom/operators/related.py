"""Headwords as sparse features of their relations, and related headwords by expansion from headword to headword."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut

# The decay along an entry's relations, how many of each kind count, and what a kind starts with at least.
DECAY = 0.95
KINDS = (("related", 16, 1.0), ("rephrase", 4, 1.0), ("translation", 20, 0.4), ("cooccurrence", 20, 0.2))
# What later seeds and repeated ones weigh, and the fan-out of a headword, shrinking with the number of results.
NEXT_SEED, REPEATED = 0.8, 0.1
MOST_LINKS, LEAST_LINKS, MOST_TRANSLATIONS, LEAST_TRANSLATIONS = 16, 4, 8, 2


def entry_features(relations: DataFrame, poses: DataFrame) -> DataFrame:
    """key, label, weight: the headword itself and its parts of speech (as '__pos', relative to the commonest), then its relations.

    relations: key, kind, place (from 0), label; poses: key, pos, n. Each label that is new to the entry weighs 0.95 of the one
    before; translations begin at 0.4 and co-occurring words at 0.2 at least. Each kind counts up to its bound.
    """
    number = F.coalesce(*(F.when(F.col("kind") == kind, n) for n, (kind, _, _) in enumerate(KINDS)))
    most = F.coalesce(*(F.when(F.col("kind") == kind, most) for kind, most, _ in KINDS))
    listed = relations.where(number.isNotNull() & (F.col("place") < most) & (F.col("label") != F.col("key")))
    once = listed.groupBy("key", "label").agg(F.min(F.struct(number.alias("kind"), "place")).alias("at")).select("key", "label", "at.*")
    part = Window.partitionBy("key")
    within = part.orderBy("kind", "place", "label")
    counted = once.withColumn("i", F.row_number().over(within))
    counted = counted.withColumns({f"n{n}": F.sum((F.col("kind") == n).cast("int")).over(part) for n in range(len(KINDS))})
    start, before, weight = F.lit(1.0), F.lit(0), None
    for n, (_, _, least) in enumerate(KINDS):
        start = F.greatest(start, F.lit(least)) if least < 1 else start
        here = start * F.pow(F.lit(DECAY), (F.col("i") - before).cast("double"))
        weight = F.when(F.col("kind") == n, here) if weight is None else weight.when(F.col("kind") == n, here)
        start, before = start * F.pow(F.lit(DECAY), F.col(f"n{n}").cast("double")), before + F.col(f"n{n}")
    own = relations.select("key").unionByName(poses.select("key")).distinct().select("key", F.col("key").alias("label"), F.lit(1.0).alias("weight"))
    kinds = poses.select("key", F.concat(F.lit("__"), "pos").alias("label"), (F.col("n") / F.max("n").over(part)).alias("weight"))
    return own.unionByName(counted.select("key", "label", weight.alias("weight"))).unionByName(kinds).groupBy("key", "label").agg(F.max("weight").alias("weight"))


def expand(queries: DataFrame, features: DataFrame, links: DataFrame, translations: DataFrame, capacity: int = 100, rounds: int = 3) -> DataFrame:
    """qid, key, score, place: headwords reached from the queries' headwords (qid, q with members parted by commas), best first.

    Each round expands the best headwords reached so far and not yet expanded: their links (key, place, label) and the headwords
    that share their first translations (key, place, label), ever fewer as results grow and as their likeness to the seeds falls.
    The seeds' features, later seeds at 0.8 of the one before, are what all are compared with. Instead of one headword at a time
    as a single user's search would, a round takes all that one headword could lead to for every query at once; so more may be
    looked at, and the best by score stay. At most max(1.2 x capacity, 100) headwords are kept for a query.
    """
    keep = max(int(capacity * 1.2), 100)
    asked = queries.select("qid", F.posexplode(F.split("q", ",")).alias("n", "key")).select("qid", "n", F.trim("key").alias("key"))
    asked = asked.join(features.select("key").distinct(), "key")
    order = Window.partitionBy("qid").orderBy("n")
    seeds = asked.withColumn("n", F.row_number().over(order) - 1).withColumn("again", F.row_number().over(Window.partitionBy("qid", "key").orderBy("n")) > 1)
    weight = F.pow(F.lit(NEXT_SEED), F.col("n").cast("double")) * F.when(F.col("again"), REPEATED).otherwise(1.0)
    wanted = cut(seeds.join(features, "key").groupBy(F.col("qid").alias("seed"), "label").agg(F.sum(weight * F.col("weight")).alias("weight")))

    def scored(pairs: DataFrame) -> DataFrame:
        """qid, key with their likeness to the query's seeds."""
        near = pairs.join(features, "key").join(wanted.withColumnsRenamed({"seed": "qid", "weight": "w"}), ["qid", "label"])
        dot = near.groupBy("qid", "key").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("other"))
        norm = wanted.groupBy(F.col("seed").alias("qid")).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
        score = F.least(F.col("dot") / (F.col("norm") * F.col("other")), F.lit(1.0))
        return dot.join(norm, "qid").select("qid", "key", F.round(F.when(score >= 0.99999, 1.0).otherwise(score), 9).alias("score"))

    best = Window.partitionBy("qid").orderBy(F.desc("score"), "key")
    found = cut(scored(seeds.select("qid", "key").distinct()).withColumn("open", F.lit(True)))
    for step in range(1, rounds + 1):
        fan = F.log2(F.lit(step + 1.0))
        front = found.where("open").select("qid", "key", "score")
        most = lambda base, least: F.greatest((F.lit(base) / fan * F.col("score")).cast("int"), F.lit(least))
        by_link = front.join(links, "key").where(F.col("place") < most(MOST_LINKS, LEAST_LINKS)).select("qid", F.col("label").alias("key"))
        shared = front.join(translations, "key").where(F.col("place") < most(MOST_TRANSLATIONS, LEAST_TRANSLATIONS)).select("qid", "label").distinct()
        first = F.row_number().over(Window.partitionBy("label").orderBy("place", "key"))
        listed = translations.withColumn("r", first).where("r <= 10").select("label", "key")
        by_translation = shared.join(listed, "label").select("qid", "key")
        fresh = by_link.unionByName(by_translation).distinct().join(found.select("qid", "key"), ["qid", "key"], "left_anti")
        grown = found.withColumn("open", F.lit(False)).unionByName(scored(fresh).withColumn("open", F.lit(True)))
        found = cut(grown.withColumn("r", F.row_number().over(best)).where(F.col("r") <= keep).drop("r"))
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= capacity).select("qid", "key", "score", "place")
