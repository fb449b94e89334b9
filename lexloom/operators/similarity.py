"""Similarity of texts, lists and sparse vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import twiddle_gain
from .tokenize import ngrams


def clipped_ngrams(candidates: DataFrame, references: DataFrame, longest: int) -> DataFrame:
    """id, n, matched, total: n-grams of each candidate that a reference of its key has, no more often than one reference has them.

    candidates: id, key, words. references: key, words (each once). The n-grams of a key's references are counted once for all its
    candidates. No n runs beyond the candidate's length.
    """
    gram = lambda df, *keys: df.select(*keys, F.explode(ngrams(F.col("words"), longest)).alias("g")).groupBy(*keys, "g").agg(F.count("*").alias("c"))
    best = gram(references.withColumn("ref", F.xxhash64("words")), "key", "ref").groupBy("key", "g").agg(F.max("c").alias("r"))
    n = F.size(F.split("g", " "))
    return gram(candidates, "id", "key").join(best, ["key", "g"], "left").groupBy("id", n.alias("n")).agg(F.sum(F.least("c", F.coalesce("r", F.lit(0)))).alias("matched"), F.sum("c").alias("total"))


def bleu(candidates: DataFrame, references: DataFrame, longest: int = 4) -> DataFrame:
    """id, bleu, precision: geometric mean of clipped precisions with brevity penalty, and their arithmetic mean.

    bleu is 0 where some n has no match. Candidates without words or whose key has no references have no row.
    """
    stat = clipped_ngrams(candidates, references, longest).groupBy("id").agg(
        F.exp(F.avg(F.log(F.col("matched") / F.col("total")))).alias("mean"), F.min("matched").alias("least"), F.avg(F.col("matched") / F.col("total")).alias("precision")
    )
    sized = candidates.select("id", "key", F.size("words").alias("len"))
    lengths = references.select("key", F.size("words").alias("ref_len")).distinct()
    closest = sized.join(lengths, "key").groupBy("id", "len").agg(F.min(F.struct(F.abs(F.col("ref_len") - F.col("len")), "ref_len"))["ref_len"].alias("ref_len"))
    penalty = F.least(F.lit(1.0), F.exp(1 - F.col("ref_len") / F.col("len")))
    return stat.join(closest, "id").select("id", F.when(F.col("least") == 0, 0.0).otherwise(F.col("mean") * penalty).alias("bleu"), "precision")


def twiddle(lists: DataFrame) -> DataFrame:
    """qid, q, word, i, score, place: words of ranked lists, re-ranked by likeness to the query. lists: qid, q, words."""
    each = lists.select("qid", "q", F.posexplode("words").alias("i", "word"), F.size("words").alias("n"))
    score = F.round(10 / (10 + F.col("i")) * twiddle_gain(F.col("word"), F.col("q"), F.col("n")), 9)
    return each.withColumn("score", score).withColumn("place", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "i"))).drop("n")


def seed_cosine(seeds: DataFrame, vectors: DataFrame) -> DataFrame:
    """seed, id, score: cosine over the seed's own labels only, so labels that the seed lacks don't lower it.

    seeds: seed, label, weight. vectors: id, label, weight. Pairs without a common label have no row.
    """
    norm = seeds.groupBy("seed").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    both = seeds.withColumnRenamed("weight", "a").join(vectors.withColumnRenamed("weight", "b"), "label")
    dot = both.groupBy("seed", "id").agg(F.sum(F.col("a") * F.col("b")).alias("dot"), F.sqrt(F.sum(F.col("b") * F.col("b"))).alias("other"))
    score = F.least(F.col("dot") / (F.col("norm") * F.col("other")), F.lit(1.0))
    return dot.join(norm, "seed").select("seed", "id", F.when(score >= 0.99999, 1.0).otherwise(score).alias("score"))


def softmax(score: Column, *by: str) -> Column:
    """exp(x) over its sum within `by`, shifted by the greatest so that it can't overflow."""
    part = Window.partitionBy(*by)
    shifted = F.exp(score - F.max(score).over(part))
    return shifted / F.sum(shifted).over(part)
