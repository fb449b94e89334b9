"""Corpus statistics: n-gram, word and co-occurrence counts, probabilities and association scores.

All counts are exact sums over the whole corpus with partial aggregation before each shuffle. Totals are one-row frames that are
joined by cross join with a single row. Sentences are tokenised once (`sentence_tokens`, materialised by callers that read it
more than once) and counted from there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import word_weight
from ..runtime import bounded, cut, work_partitions
from .tokenize import document_sentences, key_forms, ngrams, sentences, tokens

# Reach of a co-occurrence window, decay by distance and over sentences, scale and exponents of scores.
WINDOW, DECAY, OTHER_SENTENCE, SCALE = 20, 0.95, 0.5, 1000
MAX_IDF, IDF_POWER, MAX_PROB = 10.0, 1.5, 0.05
# Least probabilities of phrases.
LEAST_SINGLE, LEAST_MULTI, ODD_PENALTY = 1e-7, 1e-6, 10.0
# Floor and penalties of the phrase back-off.
FLOOR, SHORTER, FALLBACK = 1e-9, 0.3, 0.1


def english(documents: DataFrame) -> DataFrame:
    return documents.where(F.lower("lang") == "en")


def sentence_tokens(documents: DataFrame, lowering: bool) -> DataFrame:
    """doc_id, sent_id, words of all sentences that have a token."""
    found = document_sentences(documents).select("doc_id", "sent_id", tokens(F.col("sentence"), lowering).alias("words"))
    return found.where(F.size("words") > 0)


def lowered(sentences: DataFrame) -> DataFrame:
    """The same sentences with their words in key form."""
    return sentences.withColumn("words", key_forms(F.col("words")))


def totals(sentences: DataFrame) -> DataFrame:
    """One row: n_docs (with a token), n_sentences, n_words, of tokenised sentences."""
    by_doc = sentences.groupBy("doc_id").agg(F.count("*").alias("s"), F.sum(F.size("words")).alias("w"))
    return by_doc.agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("s"), F.lit(0)).alias("n_sentences"), F.coalesce(F.sum("w"), F.lit(0)).alias("n_words"))


def sentence_total(sentences: DataFrame) -> DataFrame:
    """One row: n_sentences."""
    return sentences.agg(F.count("*").alias("n_sentences"))


def sentence_phrases(words: Column, longest: int = 3) -> Column:
    """The set of 1..longest-grams of a sentence; a capitalised head word counts in lower case as well."""
    head = F.element_at(words, 1)
    lowered = F.concat(F.array(F.lower(head)), F.slice(words, 2, longest))
    heads = F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.lit(longest))), lambda n: F.array_join(F.slice(lowered, F.lit(1), n), " "))
    extra = F.when(head.rlike(r"^\p{Lu}[-\p{Ll}]+$"), heads).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(ngrams(words, longest), extra))


def ngram_counts(sentences: DataFrame, longest: int = 3) -> DataFrame:
    """phrase, cnt: in how many tokenised sentences each phrase stands."""
    return sentences.select(F.explode(sentence_phrases(F.col("words"), longest)).alias("phrase")).groupBy("phrase").agg(F.count("*").alias("cnt"))


def phrase_probs(counts: DataFrame, n_sentences: DataFrame) -> DataFrame:
    """phrase, cnt, prob of the phrases likely enough for their shape."""
    phrase = F.col("phrase")
    least = F.when(F.contains(phrase, F.lit(" ")), LEAST_MULTI).otherwise(LEAST_SINGLE)
    odd = phrase.rlike(r"\d") | phrase.rlike(r"(^|[^\p{L}\p{N}_])-") | phrase.rlike(r"-($|[^\p{L}\p{N}_])")
    probs = counts.crossJoin(n_sentences.select("n_sentences")).withColumn("prob", F.col("cnt") / F.col("n_sentences"))
    return probs.where(F.col("prob") >= F.when(odd, least * ODD_PENALTY).otherwise(least)).select("phrase", "cnt", "prob")


def back_off(phrases: DataFrame, probs: DataFrame) -> DataFrame:
    """phrase, prob: the probability of any phrase, backing off to shorter parts.

    The whole phrase counts if it has at most three tokens and is known; else the harmonic mean over all its n-grams, for the
    largest n of which all are known, times 0.3 for each token left over and 0.1 for each n that failed; 1e-9 at least.
    """
    parts = phrases.select("phrase").distinct().withColumn("w", tokens(F.col("phrase")))
    n_tokens = F.size("w")
    wanted = parts.select("phrase", n_tokens.alias("len"), F.explode(F.sequence(F.lit(1), F.least(F.greatest(n_tokens, F.lit(1)), F.lit(3)))).alias("n"), "w").where("len > 0")
    grams = wanted.select("phrase", "len", "n", F.explode(F.transform(F.sequence(F.lit(1), F.col("len") - F.col("n") + 1), lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("gram"))
    known = probs.select(F.col("phrase").alias("gram"), "prob")
    levels = (
        grams.join(known, "gram", "left")
        .groupBy("phrase", "len", "n")
        .agg(F.count("*").alias("all"), F.count("prob").alias("hits"), F.sum(1 / F.col("prob")).alias("inverse"))
        .where("`all` = hits")
    )
    failed = F.least("len", F.lit(3)) - F.col("n")
    value = F.col("hits") / F.col("inverse") * F.pow(F.lit(SHORTER), F.col("len") - F.col("n")) * F.pow(F.lit(FALLBACK), failed)
    best = levels.groupBy("phrase").agg(F.max_by(value, "n").alias("prob"))
    return parts.select("phrase").join(best, "phrase", "left").select("phrase", F.greatest(F.coalesce("prob", F.lit(0.0)), F.lit(FLOOR)).alias("prob"))


def word_counts(sentences: DataFrame) -> DataFrame:
    """word, cnt: in how many tokenised sentences (words in key form) each word stands."""
    return sentences.select(F.explode(F.array_distinct("words")).alias("word")).where("word != ''").groupBy("word").agg(F.count("*").alias("cnt"))


#: Words whose pairs are made at once: what a task holds of them grows with this alone.
CHUNK_WORDS = 100_000
_DECAYED = np.array([[0, *(int(SCALE * DECAY ** (d - 1) * w) for d in range(1, WINDOW + 1))] for w in (1.0, OTHER_SENTENCE)], np.int64)


def _pair_sums(words: np.ndarray, sent: np.ndarray, first: np.ndarray, doc: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """word, other word, score: sums over the anchors (`first`) of documents laid end to end, the best score of each other word counting."""
    keys, scores = [], []
    for d in range(1, min(WINDOW, len(words) - 1) + 1):
        score = np.where(sent[d:] == sent[:-d], _DECAYED[0][d], _DECAYED[1][d])
        near = (doc[d:] == doc[:-d]) & (words[d:] != words[:-d])
        for anchor, other in ((slice(None, -d), slice(d, None)), (slice(d, None), slice(None, -d))):
            at = np.flatnonzero(near & first[anchor])
            keys.append((at + (anchor.start or 0)) * n_words + words[other][at])
            scores.append(score[at])
    if not keys:
        none = np.empty(0, np.int64)
        return none, none, none
    key, score = np.concatenate(keys), np.concatenate(scores)
    ranked = np.sort(key * (SCALE + 1) + (SCALE - score))  # the best score of each anchor and word comes first
    key, score = ranked // (SCALE + 1), SCALE - ranked % (SCALE + 1)
    best = np.concatenate([[True], key[1:] != key[:-1]])
    key, score = key[best], score[best]
    pair, place = np.unique(words[key // n_words] * n_words + key % n_words, return_inverse=True)
    return pair // n_words, pair % n_words, np.bincount(place, score).astype(np.int64)


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (array of sentences, each an array of words) to word, cooc, score, summed for some documents at a time."""

    def close(held: list) -> pa.RecordBatch:
        code: dict[str, int] = {}
        words, sent, first, doc = [], [], [], []
        for n, sentences in enumerate(held):
            for number, sentence in enumerate(sentences):
                seen = set()
                for word in sentence:
                    if word:
                        words.append(code.setdefault(word, len(code)))
                        sent.append(number)
                        doc.append(n)
                        first.append(word not in seen)
                        seen.add(word)
        a, b, score = _pair_sums(np.array(words, np.int64), np.array(sent), np.array(first, bool), np.array(doc), max(len(code), 1))
        names = pa.array(list(code), pa.string())
        return pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(score)], names=["word", "cooc", "score"])

    held, size = [], 0
    for batch in batches:
        for sentences in batch.column(0).to_pylist():
            n = sum(map(len, sentences))
            if held and size + n > CHUNK_WORDS:
                yield close(held)
                held, size = [], 0
            held.append(sentences)
            size += n
    if held:
        yield close(held)


def document_words(documents: DataFrame) -> DataFrame:
    """doc_id, sentences array<array<string>> of documents, words in key form; a document's sentences never leave its row."""
    of = F.transform(sentences(F.col("text")), lambda s: tokens(s, True))
    return documents.select("doc_id", F.filter(of, lambda w: F.size(w) > 0).alias("sentences")).where(F.size("sentences") > 0)


def each_sentence(word_lists: DataFrame) -> DataFrame:
    """doc_id, sent_id, words of `document_words`."""
    return word_lists.select("doc_id", F.posexplode("sentences").alias("sent_id", "words"))


def cooccurrences(word_lists: DataFrame, counts: DataFrame, least_word: int = 16) -> DataFrame:
    """word, cooc, score: the decayed co-occurrence sums of the words that reach `least_word` weighted sentences.

    The anchor of a word is its first place in a sentence; around it the best score of each other word within 20 places counts.
    Scores are cut to whole thousandths before they are summed, so sums are exact. word_lists: see `document_words`; counts:
    materialised. Pairs are made and summed some documents at a time where the documents lie, over Arrow batches, and only sums are
    shuffled. A document of more than CHUNK_WORDS words is worked on whole. Rare words keep their places while pairs are made.
    """
    frequent = bounded(counts.where(F.col("cnt") * word_weight(F.col("word")) >= least_word).select("word"))
    dealt = word_lists.select("sentences").repartition(work_partitions(word_lists.sparkSession))
    pairs = dealt.mapInArrow(_pairs_of, "word string, cooc string, score bigint")
    kept = pairs.join(frequent, "word").join(frequent.withColumnRenamed("word", "cooc"), "cooc")
    return kept.groupBy("word", "cooc").agg(F.sum("score").alias("score"))


def idf(prob: Column) -> Column:
    return F.least(-F.log(prob), F.lit(MAX_IDF))


def top_cooccurrences(coocs: DataFrame, counts: DataFrame, n_sentences: DataFrame, least: int = 4000, top: int = 256) -> DataFrame:
    """word, cooc, score, rank: per word the `top` co-occurring words by score, idf and weights; sums under `least` are left out."""
    total = n_sentences.select("n_sentences")
    other = counts.select(F.col("word").alias("cooc"), F.col("cnt").alias("cooc_cnt"))
    a, b = word_weight(F.col("word")), word_weight(F.col("cooc"))
    scored = coocs.join(other, "cooc").crossJoin(total).where(F.col("score") * a * b >= least)
    value = F.col("score") * F.pow(idf(F.col("cooc_cnt") / F.col("n_sentences")), F.lit(IDF_POWER)) * a * b
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("word").orderBy(F.round(value, 6).desc(), "cooc")))
    return ranked.where(F.col("rank") <= top).select("word", "cooc", "score", "rank")


def cooccurrence_probs(coocs: DataFrame, word_probs: DataFrame, n_sentences: DataFrame, top: int = 256) -> DataFrame:
    """word, cooc, prob, rank: how many weighted times a word's sentences have the other word."""
    total = n_sentences.select("n_sentences")
    own = word_probs.select("word", F.col("prob").alias("word_prob"))
    other = word_probs.select(F.col("word").alias("cooc"), F.col("prob").alias("cooc_prob"))
    joined = coocs.join(own, "word").join(other, "cooc").crossJoin(total)
    prob = F.col("score") / SCALE / F.greatest(F.bround(F.col("word_prob") * F.col("n_sentences")), F.lit(1.0))
    value = prob * F.pow(idf(F.col("cooc_prob")), F.lit(IDF_POWER)) * word_weight(F.col("cooc"))
    ranked = joined.withColumn("prob", prob).withColumn("rank", F.row_number().over(Window.partitionBy("word").orderBy(F.round(value, 9).desc(), "cooc")))
    return ranked.where(F.col("rank") <= top).select("word", "cooc", "prob", "rank")


def score_table(cooc_probs: DataFrame, word_probs: DataFrame, top: int = 128) -> DataFrame:
    """word, idf_score, cooc, cooc_score: whole thousandths of idf and co-occurrence scores, the best `top` per word."""
    own = word_probs.select("word", F.col("prob").alias("word_prob"))
    other = word_probs.select(F.col("word").alias("cooc"), F.col("prob").alias("cooc_prob"))
    whole = lambda c: F.floor(F.round(c * SCALE, 6)).cast("bigint")
    joined = cooc_probs.join(own, "word").join(other, "cooc")
    own_score = F.pow(idf(F.col("word_prob")), F.lit(IDF_POWER)) * word_weight(F.col("word"))
    score = F.least("prob", F.lit(MAX_PROB)) * F.pow(idf(F.col("cooc_prob")), F.lit(IDF_POWER)) * word_weight(F.col("cooc"))
    ranked = joined.select("word", whole(own_score).alias("idf_score"), "cooc", whole(score).alias("cooc_score"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("word").orderBy(F.desc("cooc_score"), "cooc")))
    return ranked.where(F.col("rank") <= top).drop("rank")


def word_features(table: DataFrame) -> DataFrame:
    """word, label, weight: each word's own and co-occurring words as weighted features."""
    own = table.select("word", "idf_score").distinct()
    itself = own.select("word", F.col("word").alias("label"), (MAX_PROB * F.col("idf_score") * F.col("idf_score") / SCALE**2 * word_weight(F.col("word"))).alias("weight"))
    others = table.select("word", F.col("cooc").alias("label"), (F.col("cooc_score") * F.col("idf_score") / SCALE**2 * word_weight(F.col("cooc"))).alias("weight"))
    return itself.unionByName(others)


def related_words(queries: DataFrame, table: DataFrame, trace: int = 32, check_cooc: int = 16, check_rel: int = 128, features: int = 256) -> DataFrame:
    """query, word, score: words related to each query's words over two steps of co-occurrence, by seed-side cosine.

    queries: query, word (its words). A batch of queries is one join; nothing is looped over.
    """
    vectors = word_features(table)
    seeds = queries.join(vectors, "word").groupBy("query", "label").agg(F.sum("weight").alias("weight"))
    by_weight = Window.partitionBy("query").orderBy(F.round("weight", 9).desc(), "label")
    seeds = seeds.withColumn("rank", F.row_number().over(by_weight))
    own = queries.select("query", F.col("word").alias("label"))
    fresh = seeds.join(own, ["query", "label"], "left_anti").withColumn("rank", F.row_number().over(by_weight))
    traced = fresh.where(F.col("rank") <= trace).select("query", F.col("label").alias("word"), F.col("weight").alias("via"))
    reached = traced.join(vectors, "word").join(own, ["query", "label"], "left_anti").groupBy("query", "label").agg(F.max(F.col("via") * F.col("weight")).alias("weight"))
    near = fresh.where(F.col("rank") <= check_cooc).select("query", "label")
    far = reached.join(near, ["query", "label"], "left_anti").withColumn("rank", F.row_number().over(by_weight)).where(F.col("rank") <= check_rel).select("query", "label")
    candidates = own.unionByName(near).unionByName(far).distinct().withColumnRenamed("label", "word")
    seed = seeds.where(F.col("rank") <= features).select("query", "label", F.col("weight").alias("seed"))
    norms = seed.groupBy("query").agg(F.sqrt(F.sum(F.col("seed") * F.col("seed"))).alias("norm"))
    shared = candidates.join(vectors, "word").join(seed, ["query", "label"]).groupBy("query", "word").agg(
        F.sum(F.col("seed") * F.col("weight")).alias("dot"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("other")
    )
    score = F.least(F.col("dot") / (F.col("norm") * F.col("other")), F.lit(1.0))
    return shared.join(norms, "query").select("query", "word", F.when(score >= 0.99999, 1.0).otherwise(score).alias("score"))


def pair_counts(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From (domain, src, trg), each once: in how many domains each source, target and pair stands."""
    pairs = cut(pairs)
    count = lambda *by: pairs.groupBy(*by).agg(F.countDistinct("domain").alias("cnt"))
    return count("src"), count("trg"), count("src", "trg")


def association(src: DataFrame, trg: DataFrame, pair: DataFrame, least_pair: int = 2, least: float = 0.01, long_target: int = 3, often: int = 10) -> DataFrame:
    """src, trg, cnt, ef, fe, score: smoothed shares of the pair among both its sides.

    A pair stays if its score is high enough or its target is long and frequent.
    """
    joined = pair.where(F.col("cnt") >= least_pair).join(src.withColumnRenamed("cnt", "src_cnt"), "src").join(trg.withColumnRenamed("cnt", "trg_cnt"), "trg")
    ef, fe = F.col("cnt") / (F.col("src_cnt") + 2), F.col("cnt") / (F.col("trg_cnt") + 2)
    kept = (F.round(ef * fe, 12) >= least) | ((F.char_length("trg") >= long_target) & (F.col("trg_cnt") >= often))
    return joined.where(kept).select("src", "trg", "cnt", ef.alias("ef"), fe.alias("fe"), (ef * fe).alias("score"))
