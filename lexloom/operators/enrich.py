"""What is added to the merged lexicon: relations, idioms, ages of acquisition, inherited inflections, reverse translations.

Every step is a function of the frames before it, so none depends on the order in which headwords are worked through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_stop_word, java
from .search import PARTICLES

# Words that carry no meaning of their own in phrases and definitions.
HOLLOW_WORDS = (
    "the a an I my me mine you your yours he his him she her hers it its they their them theirs we our us ours some any one someone something myself yourself yourselves himself herself "
    "itself themselves oneself who whom whose what where when why how and but not no never ever time place people person this these that those other another yes thou back much many more "
    "most good well better best all"
).split()
# Weights of relations, by kind.
RELATION_WEIGHTS = {"synonym": 1.0, "hypernym": 0.9, "hyponym": 0.8, "antonym": 0.2, "derivative": 0.7, "relation": 0.5}
# The least probability of a headword with idioms, the least share of its idioms, what particles and places count.
LEAST_PROB, LEAST_SHARE, TRIPLE, AT_END, AT_PIVOT = 1e-6, 0.001, 3.0, 0.9, 0.8


def is_valid_key(key: Column) -> Column:
    """Whether a key may head an entry: some Latin letter, and more than a number or an ordinal."""
    return key.rlike(java(r"\p{Latin}")) & ~key.rlike(r"^\d+(st|nd|rd)?$")


def frequency_closeness(prob: Column, to: float = 0.001) -> Column:
    """1 at the probability `to`, falling as the ratio does either way."""
    return F.exp(-F.abs(F.log(F.lit(to)) - F.log(F.greatest(prob, F.lit(1e-7)))))


def list_bound(n_items: Column, times: int) -> Column:
    """How many related words an entry of `n_items` items shows."""
    return (F.least(F.greatest(F.log2(n_items.cast("double")), F.lit(2.0)), F.lit(6.0)) * times).cast("int")


def _with_first(phrases: DataFrame, entry: DataFrame, token: Column) -> DataFrame:
    """Phrases joined with the headword that is one of their tokens."""
    word = entry.where((F.col("prob") >= LEAST_PROB) & F.col("key").rlike(java(r"^[-\p{Latin}]+$"))).select(F.col("key").alias("word"), F.col("prob").alias("word_prob"), F.col("n_items").alias("word_items"))
    return phrases.withColumn("word", token).join(word, "word")


def pivot_tokens(entry: DataFrame) -> DataFrame:
    """key, rarest: of each headword of several words the rarest token that carries meaning, the last of equals."""
    several = entry.where(F.contains("key", F.lit(" ")) & (F.col("prob") >= LEAST_PROB)).select("key", F.posexplode(F.split("key", " ")).alias("at", "token"))
    own = several.where(~F.col("token").isin(PARTICLES + HOLLOW_WORDS) & F.col("token").rlike(java(r"^[-'\p{Latin}]+$")))
    rated = own.join(entry.select(F.col("key").alias("token"), "prob"), "token", "left").withColumn("prob", F.coalesce("prob", F.lit(0.0)))
    return rated.groupBy("key").agg(F.min_by("token", F.struct("prob", -F.col("at"))).alias("rarest"))


def idioms(entry: DataFrame) -> DataFrame:
    """word, place, idiom: headwords of several words by their first word, their last and their rarest, the commonest first.

    entry: key, prob, n_items, moving (whether it is a verb, adjective or adverb). All three meet on a token, so no range is
    scanned. Phrases with a particle, and verbs, adjectives and adverbs, count thrice; of several ways the best counts.
    """
    w = F.split("key", " ")
    phrases = entry.where(F.size(w) > 1).select("key", "prob", "moving", w.alias("w"))
    particle = lambda words: F.when(F.exists(words, lambda x: x.isin(PARTICLES)), TRIPLE).otherwise(1.0)
    size = F.size("w")
    first = _with_first(phrases, entry, F.get("w", F.lit(0))).withColumn("times", particle(F.slice("w", F.lit(2), size)))
    last = _with_first(phrases, entry, F.get("w", size - 1)).withColumn("times", particle(F.slice("w", F.lit(1), size - 1)) * AT_END)
    mid = _with_first(phrases.join(pivot_tokens(entry), "key"), entry, F.col("rarest")).drop("rarest").withColumn("times", particle(F.col("w")) * AT_PIVOT)
    all_ways = first.unionByName(last).unionByName(mid)
    share = F.col("prob") / F.col("word_prob")
    score = share * F.col("times") * F.when(F.col("moving"), TRIPLE).otherwise(1.0)
    best = all_ways.where((share >= LEAST_SHARE) & (F.col("key") != F.col("word"))).groupBy("word", "key", "word_items").agg(F.max(F.round(score, 9)).alias("score"))
    place = F.row_number().over(Window.partitionBy("word").orderBy(F.desc("score"), "key"))
    return best.withColumn("place", place).where(F.col("place") <= list_bound(F.col("word_items"), 4)).select("word", "place", F.col("key").alias("idiom"))


def related(relations: DataFrame, entry: DataFrame, edges: DataFrame) -> DataFrame:
    """key, place, related: the words that the sources relate to a headword, by votes.

    relations: key, rel (key form), kind, label, place (from 0). A vote falls along its list and counts by its kind; of a label the
    best vote counts once, and labels add up. Common words gain a little, stop words lose most. Only headwords count, no parent,
    child or the word itself.
    """
    weight = F.coalesce(*(F.when(F.col("kind") == k, w) for k, w in RELATION_WEIGHTS.items()), F.lit(0.0)) * 30 / (F.least("place", F.lit(30)) + 30)
    by_label = relations.where("rel != key").groupBy("key", "rel", "label").agg(F.max(F.round(weight, 9)).alias("w"))
    votes = by_label.groupBy("key", "rel").agg(F.sum("w").alias("votes"))
    family = edges.select(F.col("child").alias("key"), F.col("parent").alias("rel")).unionByName(edges.select(F.col("parent").alias("key"), F.col("child").alias("rel"))).distinct()
    fresh = votes.join(family, ["key", "rel"], "left_anti")
    known = fresh.join(entry.select(F.col("key").alias("rel"), "prob"), "rel").join(entry.select("key", "n_items"), "key")
    stop = F.when(~is_stop_word(F.col("rel")), 1.0).when(is_stop_word(F.col("key")), 0.3).otherwise(0.1)
    score = F.round(F.col("votes") * (1 + 0.1 * frequency_closeness(F.col("prob"))) * stop, 9)
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "rel"))
    scored = known.withColumn("score", score).withColumn("place", place)
    return scored.where(F.col("place") <= list_bound(F.col("n_items"), 6)).select("key", "place", F.col("rel").alias("related"))


def acquisition(entry: DataFrame, ages: DataFrame, concepts: DataFrame, bases: DataFrame) -> DataFrame:
    """key, aoa, aoa_concept, aoa_base of headwords that have any.

    entry: key, prob, share; ages: key, aoa; concepts: key, concept (stems and cores); bases: key, base. A word is learnt at its own
    age, a year at most after its concept, the more the rarer it is, and a year after its base form; a small share adds up to two.
    """
    bias = F.when(F.col("share") < 0.5, (0.5 - F.col("share")) * 4).otherwise(0.0)
    known = ages.join(entry.select("key"), "key", "left_semi")
    of = known.join(entry.select("key", "prob"), "key").select(F.col("key").alias("other"), F.col("aoa").alias("other_aoa"), F.col("prob").alias("other_prob"))
    rarer = F.least(F.greatest(F.log(F.greatest("other_prob", F.lit(1e-9))) - F.log(F.least("prob", F.lit(1e-7))), F.lit(0.0)), F.lit(1.0))
    by_concept = concepts.withColumnRenamed("concept", "other").join(of, "other").join(entry.select("key", "prob"), "key").groupBy("key").agg(F.min(F.col("other_aoa") + rarer).alias("concept"))
    by_base = bases.withColumnRenamed("base", "other").join(of, "other").groupBy("key").agg(F.min(F.col("other_aoa") + 1).alias("base"))
    joined = entry.join(ages, "key", "left").join(by_concept, "key", "left").join(by_base, "key", "left")
    return joined.select("key", *(F.round(F.col(c) + bias, 3).alias(n) for c, n in (("aoa", "aoa"), ("concept", "aoa_concept"), ("base", "aoa_base")))).where("coalesce(aoa, aoa_concept, aoa_base) is not null")


def phrasal_inflections(verbs: DataFrame, forms: DataFrame) -> DataFrame:
    """key, form, value: verbs of several words inflect as their verb does: the first token that is a verb and carries meaning.

    verbs: key of all verbs; forms: key, form, value of single verbs.
    """
    several = verbs.where(F.contains("key", F.lit(" "))).select("key", F.split("key", " ").alias("w")).select("key", "w", F.posexplode("w").alias("at", "token"))
    single = verbs.where(~F.contains("key", F.lit(" "))).select(F.col("key").alias("token"))
    hollow = F.col("token").isin(PARTICLES + HOLLOW_WORDS)
    rooted = several.join(single, "token").where(~hollow | (F.col("at") == 0)).groupBy("key", "w").agg(F.min_by("token", F.struct(hollow.alias("h"), "at")).alias("root"))
    inflected = rooted.join(forms.withColumnRenamed("key", "root"), "root")
    at = F.array_position("w", F.col("root")).cast("int")
    put = F.array_join(F.concat(F.slice("w", F.lit(1), at - 1), F.array("value"), F.slice("w", at + 1, F.size("w"))), " ")
    return inflected.select("key", "form", put.alias("value"))


def without_main_translations(translations: DataFrame, mains: DataFrame, told: DataFrame) -> DataFrame:
    """The translations of minor spellings that the main one doesn't have, or that a source tells of them: key, main, translation.

    translations: key, main (the key of the main spelling), translation; mains: key, translation; told: key, translation of sources.
    """
    told = told.where(F.char_length("translation") >= 2).select("key", "translation").distinct().withColumn("own", F.lit(True))
    kept = translations.join(told, ["key", "translation"], "left")
    others = mains.select(F.col("key").alias("main"), F.col("translation").alias("theirs"))
    same = (F.col("translation") == F.col("theirs")) | ((F.char_length("theirs") >= 2) & F.contains("translation", "theirs"))
    twice = kept.where("own is null").join(others, "main").where(same).select("key", "main", "translation").distinct()
    return kept.drop("own").join(twice, ["key", "main", "translation"], "left_anti")


def compensate_reverse(entry: DataFrame, translations: DataFrame, turned: DataFrame) -> DataFrame:
    """key, translation to add: translations that no headword has, each for the first of its words that is a headword.

    turned: translation, words (array in order).
    """
    missing = turned.join(translations.select("translation").distinct(), "translation", "left_anti").select("translation", F.posexplode("words").alias("at", "key"))
    return missing.join(entry.select("key"), "key").groupBy("translation").agg(F.min_by("key", "at").alias("key")).select("key", "translation")


def word_coocs(entry: DataFrame, coocs: DataFrame, probs: DataFrame, definitions: DataFrame, top: int = 16) -> DataFrame:
    """key, place, cooc: words that a headword's words keep company with, and words of its definitions.

    coocs: word, cooc, prob, rank; probs: word, prob; definitions: key, label, words. The best 32 companions of each word count by
    its squared idf, a word of a definition a hundredth of the headword's greatest for each label; all count by their own squared
    idf, stop words a tenth, hollow ones half. Only headwords stay.
    """
    idf2 = lambda p: F.pow(-F.log(p), F.lit(2.0))
    tokens = entry.select("key", F.explode(F.array_distinct(F.split("key", " "))).alias("word")).join(probs, "word").select("key", "word", idf2(F.col("prob")).alias("w"))
    own = tokens.select("key", F.col("word").alias("cooc"))
    near = tokens.join(coocs.where("rank <= 32"), "word").select("key", "cooc", (F.col("prob") * F.col("w")).alias("s"))
    most = tokens.groupBy("key").agg(F.max("w").alias("most"))
    defined = definitions.select("key", "label", F.explode("words").alias("cooc")).where(F.col("cooc").rlike(java(r"^\p{Latin}{2,}$")) & ~F.col("cooc").isin(PARTICLES + HOLLOW_WORDS)).distinct()
    told = defined.groupBy("key", "cooc").agg(F.count("*").alias("n")).join(most, "key").select("key", "cooc", (F.col("n") * 0.01 * F.col("most")).alias("s"))
    summed = near.unionByName(told).groupBy("key", "cooc").agg(F.sum(F.round("s", 12)).alias("s")).join(own, ["key", "cooc"], "left_anti").where("cooc != key")
    rated = summed.join(probs.select(F.col("word").alias("cooc"), "prob"), "cooc").join(entry.select(F.col("key").alias("cooc")), "cooc", "left_semi")
    c = F.col("cooc")
    stop = F.when(is_stop_word(c), F.when(is_stop_word(F.col("key")), 0.3).otherwise(0.1)).when(c.isin(PARTICLES + HOLLOW_WORDS), 0.5).otherwise(1.0)
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.round(F.col("s") * idf2(F.col("prob")) * stop, 9).desc(), "cooc"))
    return rated.withColumn("place", place).where(F.col("place") <= top).select("key", "place", "cooc")


# Particles that Japanese targets begin with, and what such targets and those of few letters count.
TARGET_PARTICLES = "を に が へ や の と から で より な は です ます この その あの こと する される た て ある いる これ それ あれ れる という として だ など".split()


def top_targets(pairs: DataFrame, most: int = 64) -> DataFrame:
    """src, trg, cnt, place: the best targets of each source by count, particles and short targets counting less; none with signs."""
    t = F.col("trg")
    led = F.exists(F.array(*(F.lit(p + " ") for p in TARGET_PARTICLES)), lambda p: F.startswith(t, p))
    score = (
        F.col("cnt") * F.when(t.rlike(java(r"^[\p{Hiragana}ー]+ [\p{Hiragana}ー]+")) | t.isin(TARGET_PARTICLES), 0.5).when(led, 0.8).otherwise(1.0)
        * F.when(t.rlike(java(r"^[ \p{Hiragana}ー]+$")), 0.5).otherwise(1.0) * F.when(F.char_length(t) <= 1, 0.5).when(F.char_length(t) <= 2, 0.8).otherwise(1.0)
    )
    good = pairs.where(~t.rlike(r"[\p{S}\p{P}]")).withColumn("score", F.round(score, 9))
    place = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("score"), "trg"))
    return good.withColumn("place", place).where(F.col("place") <= most).select("src", "trg", "cnt", "place")


def select_targets(table: DataFrame, least_count: int = 10, least: float = 0.25, least_large: float = 0.35, least_stop: float = 0.3, enough: float = 2.0, most: int = 8) -> DataFrame:
    """src, place, target: the translations of each source phrase worth keeping, at most `most`.

    table: src, cnt, trg, ef, fe. Spellings with and without a capital are one: the commoner stays (a small one five times less
    easily), with the other's fe added. The score is the geometric mean of ef and fe. Single letters that begin another good target,
    targets of kana only, of odd beginnings or endings, and copies of the source fall out; short, kana and numbered ones count less.
    """
    lower = F.lower("src")
    other = F.when(F.col("src").rlike(r"^\p{Lu}"), lower).otherwise(F.concat(F.upper(F.substring("src", 1, 1)), F.expr("substring(src, 2)")))
    large = F.col("src").rlike(r"^\p{Lu}")
    good = table.where((F.col("cnt") >= least_count) & (F.char_length("src") > 1)).withColumn("other", other)
    twin = table.groupBy(F.col("src").alias("other")).agg(F.max("cnt").alias("other_cnt"))
    twin_fe = table.select(F.col("src").alias("other"), "trg", F.col("fe").alias("other_fe"))
    alone = good.join(twin, "other", "left").where((F.col("other") == F.col("src")) | F.col("other_cnt").isNull() | (F.col("cnt") >= F.col("other_cnt") * F.when(large, 5.0).otherwise(1.0)))
    merged = alone.join(twin_fe, ["other", "trg"], "left").withColumn("fe", F.when(F.col("other") == F.col("src"), F.col("fe")).otherwise(F.col("fe") + F.coalesce("other_fe", F.lit(0.0))))
    ef, fe = F.least(F.lit(1.0), "ef"), F.least(F.lit(1.0), "fe")
    scored = merged.select("src", "trg", ef.alias("ef"), fe.alias("fe"), F.round(F.sqrt(ef * fe), 9).alias("score"))
    t, size = F.col("trg"), F.char_length("trg")
    # a single letter is held against the longer targets of its source that begin with it
    longer = scored.where((F.col("score") >= least) & (size > 1)).select("src", t.alias("long"), F.left(t, F.lit(1)).alias("trg"))
    single = longer.groupBy("src", "trg").agg(F.max(~F.expr("substring(long, 2)").isin("の", "する")).alias("prefix"))
    judged = scored.join(single, ["src", "trg"], "left")
    noun = t.rlike(java(r"^\p{Han}+$"))
    stop = t.rlike(java(r"^\p{Hiragana}+$"))
    telling = F.col("src").rlike(java(r"\p{Latin}{4,}")) & ~F.col("src").rlike(r"\d") & (t.rlike(java(r"\p{Han}{2,}")) | t.rlike(java(r"\p{Han}\p{Hiragana}"))) & ((F.col("ef") >= enough) | (F.col("fe") >= enough))
    enough_score = F.when(large, F.col("score") >= least_large).when(stop, F.col("score") >= least_stop).otherwise((F.col("score") >= least) | telling)
    copy = F.contains(lower, F.lower(t)) | F.contains(F.lower(t), lower)
    odd = t.isin("する", "ます", "より", "から") | t.rlike("^[っを]|[っを]$") | t.rlike(java(r"^[\p{Hiragana}ー\p{Latin}]$|^\p{Hiragana}+[\p{Han}\p{Katakana}\p{Latin}]|[\p{Han}\p{Katakana}ー\p{Latin}][はがをと]"))
    lone_prefix = (size <= 1) & F.col("prefix").isNotNull() & (F.col("prefix") | ~noun)
    kept = judged.where(~lone_prefix & enough_score & ~copy & ~odd)
    worth = F.col("score") * F.when(size <= 1, 0.5).when(size <= 2, 0.9).otherwise(1.0) * F.when(t.rlike(java(r"^[\p{Hiragana}ー]+$")) | t.rlike(r"\d"), 0.8).otherwise(1.0)
    place = F.row_number().over(Window.partitionBy("src").orderBy(F.round(worth, 9).desc(), "trg"))
    shown = F.regexp_replace(t, java(r"([\p{Han}\p{Katakana}ー\p{Latin}])だ"), "$1な")
    return kept.withColumn("place", place).where(F.col("place") <= most).select("src", "place", shown.alias("target"))
