"""The merged lexicon: keys, shares, scores, inverted indexes, votes, inflections and relations.

Rows come as one sense each: word, label, pos, text, translation, probability. The key form of the word is the join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut
from ..functions.text import derivative_stems, normalize_word, spell_variants

# Floor of probabilities, decay of translations, pull of phrases, falling weight by age of acquisition.
LEAST_PROB, DECAY = 1e-7, 0.98
# The pattern of a short word that doubles its last letter, and endings that take -es.
DOUBLING, HISSING = "^[bcdfghklmnpqrstvwxz]+[aeiou][bcdfgklmnpqrstvz]$", "(s|ch|sh|x|o)$"


def sense_rows(rows: DataFrame) -> DataFrame:
    """key, word, label, pos, text, translation, prob; rows without a key are left out."""
    clean = rows.select(
        normalize_word(F.col("word")).alias("key"), "word", F.lower(F.trim("label")).alias("label"), F.lower(F.trim("pos")).alias("pos"),
        "text", "translation", F.greatest(F.coalesce("probability", F.lit(0.0)), F.lit(LEAST_PROB)).alias("prob"),
    )
    return clean.where("key != ''")


def merge_sources(*sources: DataFrame) -> DataFrame:
    """One row per key and label over all sources: n_items, prob, text_score, share (of the key's text score).

    The sources are united and grouped once, instead of joined outer by outer.
    """
    rows = sources[0]
    for other in sources[1:]:
        rows = rows.unionByName(other)
    score = F.log2(1 + F.coalesce(F.char_length("text"), F.lit(0)))
    by_label = rows.groupBy("key", "label").agg(F.count("*").alias("n_items"), F.max("prob").alias("prob"), F.sum(F.round(score, 9)).alias("text_score"))
    total = F.sum("text_score").over(Window.partitionBy("key"))
    return by_label.withColumn("share", F.when(total > 0, F.col("text_score") / total).otherwise(0.0))


def entries(rows: DataFrame) -> DataFrame:
    """One row per key: prob, n_items, n_labels, has_tran."""
    return rows.groupBy("key").agg(
        F.max("prob").alias("prob"), F.count("*").alias("n_items"), F.countDistinct("label").alias("n_labels"), F.max(F.col("translation").isNotNull()).alias("has_tran")
    )


def key_scores(entry: DataFrame, children: DataFrame) -> DataFrame:
    """key, score: how worth knowing a headword is, without an age of acquisition.

    children: key, n_children. Digits, outer signs and inner capitals lower the score.
    """
    joined = entry.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    key = F.col("key")
    shape = F.when(key.rlike(r"^\d+$"), 0.1).when(key.rlike(r"^\d"), 0.3).when(key.rlike(r"^[^\p{IsLatin}]|[^\p{IsLatin}]$"), 0.5).otherwise(1.0)
    score = (
        F.greatest(F.sqrt("prob"), F.lit(1e-5)) * 0.5 * F.when(F.col("has_tran"), 2.0).otherwise(1.0)
        * F.log2(F.col("n_items") + 1.0) * F.log2(F.col("n_labels") + 1.0) * F.log2(F.col("n_children") + 4.0) * shape
    )
    return joined.select("key", score.alias("score"))


def ranked(scores: DataFrame, key: str = "key", parts: int = 64) -> DataFrame:
    """Adds rank (from 1), by score from above, then key. Rows are dealt by range, materialised, and each range is numbered by itself."""
    order = [F.round("score", 9).desc(), F.col(key)]
    dealt = scores.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    dealt = cut(dealt)  # else the two branches below might be dealt by different samples
    within = dealt.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    sizes = within.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    return within.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("at")).drop("part", "at", "before")


def translation_index(rows: DataFrame) -> DataFrame:
    """translation (key form), key, score: the inverted index, each headword's translations weighted by their place.

    Translations of a key are ordered by their best probability; a later one counts 0.98 of the one before.
    """
    norm = normalize_word(F.col("translation"))
    each = rows.where("translation is not null").select("key", norm.alias("translation"), "prob").where("translation != ''")
    best = each.groupBy("key", "translation").agg(F.max("prob").alias("own"))
    prob = F.max("own").over(Window.partitionBy("key"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("own"), "translation")) - 1
    return best.withColumn("score", prob * F.pow(F.lit(DECAY), place.cast("double"))).select("translation", "key", "score")


# Endings of Japanese translations that are looked up without them, in order, and what phrases and short forms count.
SHORT_FORMS = (
    r"([\p{IsHan}\p{IsKatakana}ー]{2,})(する|すること|される|されること|をする)$",
    r"([\p{IsHan}\p{IsKatakana}ー]{2,})(的|的な|的に)$",
    r"([\p{IsHan}]{2,})(が|の|を|に|へ|と|より|から|で|や|な|なる|たる)$",
)
PHRASE_WEIGHT, SHORT_WEIGHT = 0.5, 0.8


def full_translation_index(rows: DataFrame, phrases: DataFrame, ages: DataFrame) -> DataFrame:
    """translation (key form), key, score: headwords by their translations, then by those of their phrases, and by short forms.

    phrases: key, translation; ages: key, aoa (20 where it is missing). The probability counts by how early the headword is learnt;
    each further translation of a headword counts 0.98 of the one before, phrases half, short forms 0.8 of their long ones.
    """
    entry = rows.groupBy("key").agg(F.max("prob").alias("prob"))
    own = rows.where("translation is not null").groupBy("key", "translation").agg(F.max("prob").alias("own"))
    by = Window.partitionBy("key")
    words = own.select("key", "translation", F.lit(0).alias("g"), F.row_number().over(by.orderBy(F.desc("own"), "translation")).alias("place"), F.lit(1.0).alias("w"))
    of_phrases = phrases.distinct().join(entry.select("key"), "key", "left_semi")
    phrase_rows = of_phrases.select("key", "translation", F.lit(1).alias("g"), F.row_number().over(by.orderBy("translation")).alias("place"), F.lit(PHRASE_WEIGHT).alias("w"))
    t = F.col("translation")
    form = lambda sub, text, w: F.struct(F.lit(sub).alias("sub"), text.alias("translation"), (F.col("w") * w).alias("w"))
    forms = [form(0, t, 1.0), *(F.when(t.rlike(p), form(n, F.left(t, F.char_length(t) - F.char_length(F.regexp_extract(t, p, 2))), SHORT_WEIGHT)) for n, p in enumerate(SHORT_FORMS, 1))]
    each = words.unionByName(phrase_rows).select("key", "g", "place", F.explode(F.array_compact(F.array(*forms))).alias("f"))
    named = each.select("key", "g", "place", "f.sub", normalize_word(F.col("f.translation")).alias("translation"), "f.w").where("translation != ''")
    once = named.groupBy("key", "translation").agg(F.min(F.struct("g", "place", "sub", "w")).alias("at")).select("key", "translation", "at.*")
    i = F.row_number().over(by.orderBy("g", "place", "sub")) - 1
    scored = once.withColumn("i", i).join(entry, "key").join(ages, "key", "left")
    score = F.col("prob") * (30 - F.least(F.coalesce("aoa", F.lit(20.0)), F.lit(20.0))) / 10 * F.col("w") * F.pow(F.lit(DECAY), F.col("i").cast("double"))
    return scored.select("translation", "key", score.alias("score"))


def listed(index: DataFrame, by: str, member: str, score: str = "score") -> DataFrame:
    """One row per `by`: n and members, joined by tabs from the best score down; ties by member."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.round(score, 12)).alias("s"), F.col(member).alias("m"))))
    return index.groupBy(by).agg(F.count("*").alias("n"), F.array_join(F.transform(ordered, lambda x: x["m"]), "\t").alias("members"))


def reverse_key_scores(index: DataFrame, members: str = "n", key: str = "translation") -> DataFrame:
    """key, score of translations as search keys: many headwords raise, length lowers; Hiragana and single letters count less."""
    k = F.col(key)
    score = F.sqrt(F.col(members).cast("double")) - F.char_length(k) * 1e-7
    score = score * F.when(k.rlike(r"^\p{IsHiragana}+$"), 0.2).otherwise(1.0) * F.when(F.char_length(k) == 1, 0.5).otherwise(1.0)
    return index.select(k.alias("key"), score.alias("score"))


def regular_inflections(word: Column, pos: Column) -> Column:
    """The regular inflections of a headword: array<struct<form, value>>; other parts of speech have none."""
    ends = lambda p: word.rlike(p)
    put = lambda p, by: F.regexp_replace(word, p, by)
    plus = lambda s: F.concat(word, F.lit(s))
    double = F.concat(word, F.substring(word, -1, 1))
    third = F.when(ends(HISSING), plus("es")).when(ends("[^aeiou]y$"), put("y$", "ies")).otherwise(plus("s"))
    present = F.when(ends("[^e]e$"), put("e$", "ing")).when(ends(DOUBLING), F.concat(double, F.lit("ing"))).otherwise(plus("ing"))
    past = F.when(ends("e$"), plus("d")).when(ends("[^aeiou]y$"), put("y$", "ied")).when(ends(DOUBLING), F.concat(double, F.lit("ed"))).otherwise(plus("ed"))
    stem = put("e$", "")
    stem = F.when(word.rlike("[^aeiou]y$"), put("y$", "i")).otherwise(stem)
    form = lambda name, value: F.struct(F.lit(name).alias("form"), value.alias("value"))
    none = F.array().cast("array<struct<form:string,value:string>>")
    return (
        F.when(pos == "noun", F.array(form("noun_plural", third)))
        .when(pos == "verb", F.array(form("verb_singular", third), form("verb_present_participle", present), form("verb_past", past)))
        .when(pos == "adjective", F.array(form("adjective_comparative", F.concat(stem, F.lit("er"))), form("adjective_superlative", F.concat(stem, F.lit("est")))))
        .otherwise(none)
    )


def inflection_index(rows: DataFrame) -> DataFrame:
    """form, key, score: which headwords an inflected form may come from; probability times the logarithm of the items, twice if translated."""
    words = rows.where(F.col("key").rlike("^[a-z]+$")).groupBy("key", "pos").agg(F.max("prob").alias("prob"), F.count("*").alias("n"), F.max(F.col("translation").isNotNull()).alias("t"))
    score = F.col("prob") * F.log2(F.col("n") + 0.0) * F.when(F.col("t"), 2.0).otherwise(1.0)
    each = words.select("key", score.alias("score"), F.explode(regular_inflections(F.col("key"), F.col("pos"))).alias("i"))
    return each.where("i.value != key").groupBy(F.col("i.value").alias("form"), "key").agg(F.max("score").alias("score"))


def co_translations(rows: DataFrame, least: int = 2) -> DataFrame:
    """a, b, n: translations that stand together for at least `least` keys, and for how many.

    A translation of fewer keys is in no such pair, so it goes before pairs are made: a key with very many translations pairs only
    those that other keys have too.
    """
    per_key = cut(rows.where("translation is not null").select("key", normalize_word(F.col("translation")).alias("t")).where("t != ''").distinct())
    often = per_key.groupBy("t").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("t")
    shared = per_key.join(often, "t")
    pairs = shared.withColumnRenamed("t", "a").join(shared.withColumnRenamed("t", "b"), "key").where("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def thesaurus(pairs: DataFrame) -> DataFrame:
    """translation, place (from 1), other: the co-translations of a translation, those of common keys and of more telling script first.

    pairs: a, b, n. After the second place one stays only while its count is above half its place.
    """
    both = pairs.select("a", "b", "n").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    letters = lambda script: F.char_length(F.regexp_replace("b", rf"[^\p{{Is{script}}}]", ""))
    count = F.round(F.col("n") + letters("Han") * 0.01 + letters("Katakana") * 0.001 + F.char_length("b") * 0.0001, 6)
    by = Window.partitionBy("a").orderBy(F.desc("count"), "b")
    ranked_ = both.withColumn("count", count).withColumn("place", F.row_number().over(by)).where("count >= 2")
    # counts fall and the bar rises, so what follows the first refused is refused
    refused = F.max(((F.col("place") > 3) & (F.col("count") < (F.col("place") - 1) / 2 + 1)).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return ranked_.withColumn("refused", refused).where("refused = 0").select(F.col("a").alias("translation"), "place", F.col("b").alias("other"))


def votes(rows: DataFrame, trusts: DataFrame) -> DataFrame:
    """key, translation, votes: for each label its greatest trust once, summed over labels."""
    trust = trusts.select(F.lower(F.trim("label")).alias("label"), "trust").groupBy("label").agg(F.max("trust").alias("trust"))
    norm = rows.where("translation is not null").select("key", "label", normalize_word(F.col("translation")).alias("translation")).where("translation != ''")
    by_label = norm.join(trust, "label", "left").groupBy("key", "translation", "label").agg(F.max(F.coalesce("trust", F.lit(0))).alias("w"))
    return by_label.groupBy("key", "translation").agg(F.sum("w").alias("votes"))


def best_labels(rows: DataFrame, best: tuple[str, ...] = (), vetted: tuple[str, ...] = ()) -> DataFrame:
    """key, label, cost: the source whose number and length of items come closest to what a reader wants."""
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\s\x0b\p{Z}]+"), lambda w: w != ""))
    stat = rows.withColumn("w", F.greatest(words, F.lit(1)).cast("double")).groupBy("key", "label").agg(
        F.count("*").alias("n"), F.avg(F.round(F.abs(F.log(F.lit(9.0)) - F.log("w")), 9)).alias("far")
    )
    quality = F.when(F.col("label").isin(list(best)), 0.8).when(F.col("label").isin(list(vetted)), 1.0).otherwise(1.4)
    cost = F.round((F.abs(F.log(F.lit(5.0)) - F.log("n")) + 0.5) * (F.col("far") + 1) * quality, 9)
    first = F.row_number().over(Window.partitionBy("key").orderBy("cost", "label"))
    return stat.select("key", "label", cost.alias("cost")).withColumn("r", first).where("r = 1").drop("r")


def spelling_pairs(entry: DataFrame) -> DataFrame:
    """key, variant, ratio: spellings of the other side that are headwords too, with the share of the less probable one."""
    each = entry.select("key", "prob", F.explode(spell_variants(F.col("key"))).alias("variant"))
    other = entry.select(F.col("key").alias("variant"), F.col("prob").alias("other"))
    return each.join(other, "variant").select("key", "variant", (F.least("prob", "other") / (F.col("prob") + F.col("other"))).alias("ratio"))


def derivations(entry: DataFrame, least_ratio: float = 0.1) -> DataFrame:
    """key, stem, ratio: suffix-derived headwords and the headwords they may come from, by ratio of probabilities."""
    each = entry.where(F.col("key").rlike("^[a-z]{4,}$")).select("key", "prob", F.explode(derivative_stems(F.col("key"))).alias("stem"))
    other = entry.select(F.col("key").alias("stem"), F.col("prob").alias("stem_prob"))
    ratio = F.col("stem_prob") / F.col("prob")
    return each.where("stem != key").join(other, "stem").where(ratio >= least_ratio).select("key", "stem", ratio.alias("ratio"))


def closure(edges: DataFrame, rounds: int = 3) -> DataFrame:
    """child, ancestor, distance: all ancestors up to `rounds` links away; circles don't lengthen it."""
    link = edges.select("child", "parent").distinct()
    reached = link.select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("distance"))
    edge = reached
    for step in range(2, rounds + 1):
        edge = edge.join(link.withColumnsRenamed({"child": "ancestor"}), "ancestor").select("child", F.col("parent").alias("ancestor"), F.lit(step).alias("distance"))
        reached = reached.unionByName(edge)
    return reached.where("child != ancestor").groupBy("child", "ancestor").agg(F.min("distance").alias("distance"))


def form_owners(index: DataFrame, edges: DataFrame) -> DataFrame:
    """form, owner: the headword that an inflected form belongs to; a parent's claim counts ten times."""
    parents = edges.groupBy("parent").agg(F.count("*").alias("n")).select(F.col("parent").alias("key"), F.lit(10.0).alias("weight"))
    claims = index.join(parents, "key", "left").withColumn("claim", F.round(F.col("score") * F.coalesce("weight", F.lit(1.0)), 12))
    return claims.groupBy("form").agg(F.max_by("key", F.struct("claim", "key")).alias("owner"))


def homophones(records: DataFrame) -> DataFrame:
    """sound, n, words: words of the same pronunciation, stress marks aside."""
    sound = F.regexp_replace("pronunciation", "[ˈˌ ]", "")
    each = records.where(F.col("pronunciation").rlike(r"\p{L}")).select(sound.alias("sound"), normalize_word(F.col("word")).alias("w")).where("w != ''").distinct()
    return each.groupBy("sound").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("w")), "\t").alias("words")).where("n > 1")


def inverted_entries(rows: DataFrame) -> DataFrame:
    """translation, key, score: a dictionary turned round, scored by probability and by the translation's place."""
    index = rows.where("translation is not null").select("key", normalize_word(F.col("translation")).alias("translation"), "prob").where("translation != ''")
    best = index.groupBy("key", "translation").agg(F.max("prob").alias("own"))
    prob = F.max("own").over(Window.partitionBy("key"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("own"), "translation")) - 1
    score = F.greatest(F.lit(0.1), F.sqrt(prob)) + 0.5 * F.pow(F.lit(0.8), place.cast("double"))
    return best.withColumn("score", score).select("translation", "key", "score")


def sections(scores: DataFrame, size: int = 100) -> DataFrame:
    """section, at, key: ranked headwords in sections of `size`."""
    r = ranked(scores)
    return r.select(F.floor((F.col("rank") - 1) / size).alias("section"), ((F.col("rank") - 1) % size).alias("at"), "key")


def initials(entry: DataFrame) -> DataFrame:
    """initial, n, first, last: the index of headwords by their first letter."""
    first = F.upper(F.substring("key", 1, 1))
    return entry.groupBy(F.when(first.rlike("^[A-Z]$"), first).otherwise("#").alias("initial")).agg(F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))


def redirects(edges: DataFrame, index: DataFrame, entry: DataFrame) -> DataFrame:
    """form, target: parents, children and inflected forms that are no headwords, and the least headword each leads to."""
    led = (
        edges.select(F.col("parent").alias("form"), F.col("child").alias("target"))
        .unionByName(edges.select(F.col("child").alias("form"), F.col("parent").alias("target")))
        .unionByName(index.select("form", F.col("key").alias("target")))
    )
    known = entry.select("key")
    unknown = led.join(known, led["form"] == known["key"], "left_anti").join(known.withColumnRenamed("key", "target"), "target", "left_semi")
    return unknown.groupBy("form").agg(F.min("target").alias("target"))
