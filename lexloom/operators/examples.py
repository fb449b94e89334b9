"""Example sentences: gates, scores, deduplication, postings and attachment to headwords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sentence_key, sub
from ..runtime import bounded, cut
from .tokenize import ngrams, tokens

# The best lengths of a source and of its target sentence, in characters.
BEST_SOURCE, BEST_TARGET = 57, 29
# What a target sentence does not begin with, and pronouns it does not repeat.
BAD_PREFIX = r"^[」』】］）)\].?!;,？！を。、；]"
BAD_PRONOUNS = r"あなた.*あなた|彼女.*彼女"


def reject_reason(source: Column, target: Column) -> Column:
    """Why a pair is no good example, or null; the first reason that holds."""
    count = lambda c, sign: F.char_length(c) - F.char_length(F.replace(c, F.lit(sign), F.lit("")))
    short = F.when(source.rlike("[A-Z].*[.!?]$"), 4).otherwise(3)
    s, t = F.char_length(source), F.char_length(target)
    return (
        F.when(s < BEST_SOURCE / short, "source-short")
        .when(t < BEST_TARGET / short, "target-short")
        .when(s > BEST_SOURCE * 3, "source-long")
        .when(t > BEST_TARGET * 3, "target-long")
        .when(target.rlike(BAD_PRONOUNS), "target-bad-pronoun")
        .when(target.rlike(BAD_PREFIX), "target-bad-prefix")
        .when((count(target, "、") >= 4) | (count(target, "。") >= 3) | (count(target, " ") >= 4), "target-bad-punctuation")
    )


def duplicated(pairs: DataFrame) -> DataFrame:
    """Marks (duplicate: 'source', 'target' or null) pairs whose source, or whose target among the others, an earlier pair (by id) has in
    any case; only ids meet the texts again."""
    low = pairs.select("id", F.lower("source").alias("s"), F.lower("target").alias("t"))
    first = low.groupBy("s").agg(F.min(F.struct("id", "t")).alias("r")).select("r.*")
    kept = first.groupBy("t").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("kept"))
    marked = pairs.join(first.select("id", F.lit(True).alias("first")), "id", "left").join(kept, "id", "left")
    reason = F.when(F.col("first").isNull(), "source").when(F.col("kept").isNull(), "target")
    return marked.withColumn("duplicate", reason).drop("first", "kept")


def closeness(length: Column, best: int) -> Column:
    """1 at the best length, falling as the ratio does."""
    ratio = length / F.lit(best)
    return F.least(ratio, 1 / ratio)


def rank_examples(pairs: DataFrame, exnum: DataFrame, ideal: int = 4) -> DataFrame:
    """id, source, target, score: pairs of good length, better the rarer their phrases are among examples.

    pairs: id, source, target. exnum: phrase, n (examples a phrase has).
    """
    s, t = F.char_length("source"), F.char_length("target")
    fit = pairs.where(s.between(BEST_SOURCE / 2, BEST_SOURCE * 2) & t.between(BEST_TARGET / 2, BEST_TARGET * 2))
    words = F.filter(F.split(F.lower("source"), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    grams = fit.select("id", F.explode(ngrams(words, 3)).alias("phrase"))
    bonus = grams.join(exnum.where(F.col("n") <= ideal), "phrase").groupBy("id").agg(F.sum(F.round(F.lit(ideal) * 0.1 / (F.col("n") + 2), 9)).alias("bonus"))
    length = F.sqrt(closeness(s, BEST_SOURCE) * closeness(t, BEST_TARGET))
    return fit.join(bonus, "id", "left").select("id", "source", "target", (length * (1 + F.coalesce("bonus", F.lit(0.0)))).alias("score"))


def deduplicate(pairs: DataFrame, *order: str) -> DataFrame:
    """The first pair of each source, letters alone compared in one case; copies go before the shuffle."""
    bare = sub(F.lower("source"), r"[^\p{Latin} ]+")
    rest = [c for c in pairs.columns if c not in order]
    return pairs.groupBy(bare.alias("_k")).agg(F.min(F.struct(*order, *rest)).alias("_r")).select(*(F.col(f"_r.{c}").alias(c) for c in pairs.columns))


def near_repeats(pairs: DataFrame, by: str, order: str, reach: int = 10, limit: float = 0.4) -> DataFrame:
    """Marks pairs (repeats) whose words are within an edit ratio of one of the `reach` pairs before, within `by`."""
    keyed = pairs.withColumn("_k", sentence_key(F.col("source")))
    frame = Window.partitionBy(by).orderBy(order).rowsBetween(-reach, -1)
    longest = lambda a, b: F.greatest(F.char_length(a), F.char_length(b), F.lit(1))
    near = F.exists(F.collect_list("_k").over(frame), lambda k: F.levenshtein(k, F.col("_k")) / longest(k, F.col("_k")) < limit)
    return keyed.withColumn("repeats", near).drop("_k")


def postings(sentences: DataFrame, probs: DataFrame, rarest: int = 50, sample: int = 100, longest: int = 3, seed: int = 19780211) -> DataFrame:
    """phrase, n_total, ids: for each phrase the sentences that hold it, at most `sample` chosen by a seeded digest.

    Of a sentence its `rarest` least probable phrases are posted. sentences: id, words.
    """
    each = sentences.select("id", F.explode(F.array_distinct(ngrams(F.col("words"), longest))).alias("phrase")).join(probs.select("phrase", "prob"), "phrase")
    rare = F.row_number().over(Window.partitionBy("id").orderBy("prob", "phrase"))
    kept = each.withColumn("r", rare).where(F.col("r") <= rarest).select("phrase", "id")
    totals = kept.groupBy("phrase").agg(F.count("*").alias("n_total"))
    chosen = F.row_number().over(Window.partitionBy("phrase").orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), "phrase", "id")), "id"))
    ids = kept.withColumn("r", chosen).where(F.col("r") <= sample).groupBy("phrase").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return totals.join(ids, "phrase")


def search_examples(queries: DataFrame, pairs: DataFrame, mode: str = "exact") -> DataFrame:
    """qid, id: pairs whose source holds the query. queries: qid, q, and for 'inflected' also forms (array<string>).

    'exact': as whole words, in its case; 'any': as whole words in any case; 'prefix', 'suffix': begins or ends at a word's edge;
    'contain': anywhere, in any case; 'inflected': the query or any of its forms as whole words in any case. All meet on a word
    (or, for parts of words, on three letters, shorter queries on as many as they have) before the test.
    """
    if mode == "inflected":
        asked = queries.select("qid", F.explode(F.array_distinct(F.array_append(F.coalesce("forms", F.array().cast("array<string>")), F.col("q")))).alias("q"))
        return search_examples(asked, pairs, "any").distinct()
    quoted = F.concat(F.lit(r"\Q"), "q", F.lit(r"\E"))
    edge_before, edge_after = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
    if mode in ("exact", "any"):
        word = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
        left = pairs.select("id", F.explode(F.array_distinct(word("source"))).alias("w"))
        asked = cut(queries.select("qid", "q", F.get(word("q"), F.lit(0)).alias("w")).where("w is not null"))
        pattern = F.concat(F.lit(("(?i)" if mode == "any" else "") + edge_before), quoted, F.lit(edge_after))
        test = F.regexp_like("source", pattern)
    else:
        lowered = F.lower("source")
        size = F.explode(F.sequence(F.lit(1), F.least(F.lit(3), F.char_length("source")))).alias("n")
        sized = pairs.where(F.char_length("source") > 0).select("id", lowered.alias("source"), size)
        left = sized.select("id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length("source") - F.col("n") + 1), lambda i: F.substring("source", i, F.col("n"))))).alias("w"))
        asked = cut(queries.where("q != ''").select("qid", "q", F.substring(F.lower("q"), 1, 3).alias("w")))
        pattern = F.concat(F.lit("(?i)" + edge_before), quoted) if mode == "prefix" else F.concat(F.lit("(?i)"), quoted, F.lit(edge_after))
        test = F.contains(lowered, F.lower("q")) if mode == "contain" else F.regexp_like("source", pattern)
    # only ids and grams meet; the texts of those that met follow
    met = left.join(bounded(asked), "w").select("qid", "q", "id")
    return met.join(pairs.select("id", "source"), "id").where(test).select("qid", "id").distinct()


def attach(words: DataFrame, pairs: DataFrame, most: int = 8) -> DataFrame:
    """key, id, score, place: the best examples of each headword, one source never given twice.

    words: key, prob. Each example goes to the least probable headword it holds whose quota is not full before; a source given to
    a rarer headword is left to it, so no order of processing is needed.
    """
    word = F.array_distinct(tokens(F.col("source"), True))
    gated = pairs.where(reject_reason(F.col("source"), F.col("target")).isNull())
    each = gated.select("id", "source", "target", F.posexplode(word).alias("loc", "key"), F.size(word).alias("len")).join(words, "key")
    owner = F.row_number().over(Window.partitionBy("id").orderBy("prob", "key"))
    hit = F.sqrt((F.col("len") - F.col("loc")) / F.col("len") / 2 + 0.5)
    length = F.pow(closeness(F.char_length("source"), BEST_SOURCE) * closeness(F.char_length("target"), BEST_TARGET), F.lit(0.2))
    own = each.withColumn("o", owner).where("o = 1").withColumn("score", F.round(hit * length, 9))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id"))
    return own.withColumn("place", place).where(F.col("place") <= most).select("key", "id", "score", "place")


def highlight(text: Column, forms: Column) -> Column:
    """The text with every whole-word occurrence of the forms in brackets, in any case."""
    pattern = F.concat(F.lit(r"(?i)(?<![\p{L}\p{N}_])("), F.array_join(F.transform(forms, lambda f: F.concat(F.lit(r"\Q"), f, F.lit(r"\E"))), "|"), F.lit(r")(?![\p{L}\p{N}_])"))
    return F.regexp_replace(text, pattern, F.lit("[$1]"))
