"""What a published dictionary, a word list or a quiz takes from the lexicon: choices and rankings, without any layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import java, normalize_word, trim
from .tokenize import ngrams

# Verb endings that a Japanese entry may have behind a stem of its own.
VERB_ENDINGS = "する した して している される された されて されている".split()
# Short words that are whole surfaces, the width of a quiz's window, the steepness of its levels.
SHORT_SURFACES = "go ax ox pi".split()
LEAST_WINDOW, MOST_WINDOW, RANK_GAMMA, LEVEL_RANGE, LEVEL_GAMMA = 100, 2000, 0.65, 1500, 1.6666


def keep_entries(items: DataFrame, word_probs: DataFrame, phrase_probs: DataFrame, keywords: DataFrame) -> DataFrame:
    """translation, reason: why each entry of a turned dictionary stays or goes.

    items: translation, key, tran_prob; word_probs: translation, prob; phrase_probs: key, prob; keywords: translation. In order:
    'keyword'; 'translation' from a likelihood of 0.2 on; 'word' from a probability of 1e-5; 'both' from 1e-6 and 0.02; 'phrase' from
    a headword's probability of 1e-5 and 0.02; else 'dropped'. An entry that stays but is a stem with an ending, all of whose
    headwords the stem's own entry has, is an 'affix' of it.
    """
    best = items.join(phrase_probs.select("key", F.col("prob").alias("phrase")), "key", "left").groupBy("translation").agg(F.max("tran_prob").alias("t"), F.max(F.coalesce("phrase", F.lit(0.0))).alias("p"))
    known = best.join(word_probs.select("translation", F.col("prob").alias("w")), "translation", "left").join(keywords.select("translation").distinct().withColumn("k", F.lit(True)), "translation", "left")
    w = F.coalesce("w", F.lit(0.0))
    reason = (
        F.when(F.col("k").isNotNull(), "keyword").when(F.col("t") >= 0.2, "translation").when(w >= 1e-5, "word").when((w >= 1e-6) & (F.col("t") >= 0.02), "both")
        .when((F.col("p") >= 1e-5) & (F.col("t") >= 0.02), "phrase").otherwise("dropped")
    )
    told = known.select("translation", reason.alias("reason"))
    kept = items.join(told.where("reason != 'dropped'").select("translation"), "translation").select("translation", F.lower("key").alias("key")).distinct()
    stem = F.regexp_extract("translation", f"^(.{{2,}})({'|'.join(VERB_ENDINGS)})$", 1)
    ended = kept.withColumn("stem", stem).where("stem != ''")
    of_stem = kept.withColumnsRenamed({"translation": "stem"}).withColumn("held", F.lit(True))
    has_stem = ended.select("translation", "stem").distinct().join(of_stem.select("stem").distinct(), "stem").select("translation")
    unique = ended.join(of_stem, ["stem", "key"], "left").where("held is null").select("translation").distinct()
    affix = has_stem.join(unique, "translation", "left_anti").withColumn("affix", F.lit(True))
    return told.join(affix, "translation", "left").select("translation", F.when(F.col("affix"), "affix").otherwise(F.col("reason")).alias("reason"))


def target_list(inverted: DataFrame, most: int = 8) -> DataFrame:
    """translation, place, key: the best `most` headwords of a translation, spellings of one key form once."""
    by = Window.partitionBy("translation").orderBy(F.round("score", 12).desc(), "key")
    first = inverted.withColumn("place", F.row_number().over(by)).where(F.col("place") <= most)
    norm = normalize_word(F.col("key"))
    return first.groupBy("translation", norm.alias("norm")).agg(F.min(F.struct("place", "key")).alias("at")).select("translation", "at.place", "at.key")


def good_words(entry: DataFrame, keywords: DataFrame, core_label: str, min_labels: int = 3) -> DataFrame:
    """key, score of the headwords worth a place: keywords of some probability, words of a keyword's core, and words of many sources,
    the core source among them or, for single words, any. entry: key, prob, n_items, labels (array), core (or null)."""
    known = keywords.select("key").distinct()
    marked = entry.join(known.withColumn("kw", F.lit(True)), "key", "left").join(known.select(F.col("key").alias("core"), F.lit(True).alias("core_kw")), "core", "left")
    many, blanks = F.size("labels") >= min_labels, F.char_length("key") - F.char_length(F.replace("key", F.lit(" "), F.lit("")))
    keep = (
        (F.col("kw").isNotNull() & (F.col("prob") > 1e-6)) | F.col("core_kw").isNotNull() | (F.array_contains("labels", core_label) & many & (F.col("prob") > 0))
        | ((blanks < 1) & many & (F.col("prob") >= 1e-5))
    )
    score = F.log(F.col("prob") + 1e-8) + 22 + F.size("labels") + F.log(F.col("n_items").cast("double")) - blanks
    return marked.where(keep).select("key", score.alias("score"))


def is_good_entry(key: Column, prob: Column, labels: Column, least: float, least_multi: float, sure: str = "wj", broad: str = "we") -> Column:
    """Whether an entry goes into a book. labels: of items that say more than a translation."""
    begins_oddly = key.rlike(r"(^| )[\p{Lu}\p{P}\p{S}\d]") & ~F.array_contains(labels, broad)
    thin = (prob < least_multi) & (F.contains(key, F.lit(" ")) | (F.size(labels) == 1))
    return (prob >= least) & (F.array_contains(labels, sure) | ~(begins_oddly | thin))


def is_surface(word: Column) -> Column:
    """Whether a word may be an item of a cluster: small Latin letters, more than two of them but for a few words."""
    return word.rlike("^[a-z]+$") & ((F.char_length(word) > 2) | word.isin(SHORT_SURFACES))


def entry_poses(items: DataFrame) -> DataFrame:
    """key, poses: the parts of speech of an entry's first run of items from one source, in order. items: key, at, label, pos."""
    within = Window.partitionBy("key").orderBy("at")
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    first = items.withColumn("first", F.first("label").over(so_far)).withColumn("left", F.sum((~F.col("label").eqNullSafe(F.col("first"))).cast("int")).over(so_far))
    seen = first.where("left = 0 and pos is not null").groupBy("key", "pos").agg(F.min("at").alias("at"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "pos")))
    return seen.groupBy("key").agg(F.array_join(F.transform(ordered, lambda x: x["pos"]), ",").alias("poses"))


def first_of(rows: DataFrame, section: str, word: str, least_prob: float = 0.0) -> DataFrame:
    """The rows of probable words (column prob) that no earlier section lists: each word once, in its first section."""
    rest = [c for c in rows.columns if c not in (section, word)]
    first = rows.where(F.col("prob") >= least_prob).groupBy(word).agg(F.min(F.struct(section, *rest)).alias("_r"))
    return first.select(F.col(f"_r.{section}").alias(section), word, *(F.col(f"_r.{c}").alias(c) for c in rest))


def first_annotations(annots: DataFrame) -> DataFrame:
    """id of annotations worth showing: the first of a phrase with the same letters of translation, and of these the first with a
    gloss that begins alike. annots: id (in reading order), phrase, tran, gloss."""
    letters = F.regexp_replace("tran", java(r"[^\p{Han}\p{Hiragana}\p{Katakana}]"), "")
    start = F.trim(F.left(F.lower(F.regexp_replace("gloss", java(r"[^\p{Latin} ]"), "")), F.lit(20)))
    low = F.lower("phrase")
    by_tran = annots.groupBy(low.alias("p"), letters.alias("t")).agg(F.min(F.struct("id", start.alias("g"))).alias("r"))
    return by_tran.groupBy("p", F.col("r.g").alias("g")).agg(F.min("r.id").alias("id")).select("id")


def rank_window(ranks: DataFrame, core: int) -> DataFrame:
    """The rows about a core rank: as many as the rank says, within bounds, half of them before it."""
    width = max(LEAST_WINDOW, min(core, MOST_WINDOW))
    start = max(0, int(core - width / 2))
    return ranks.where((F.col("rank") >= start) & (F.col("rank") < start + width))


def core_rank(ratio: Column, n_ranks: Column) -> Column:
    """The rank that a quiz begins at, by the share of the way through the ranks."""
    return F.floor(F.pow(ratio, F.lit(1 / RANK_GAMMA)) * n_ranks).cast("int")


def level_ranks(level: Column) -> tuple[Column, Column]:
    """The ranks of a level, from and to."""
    edge = lambda n: F.floor(F.pow(n.cast("double"), F.lit(LEVEL_GAMMA)) * LEVEL_RANGE).cast("int")
    return edge(level - 1), edge(level)


def vocabulary_age(answers: DataFrame) -> DataFrame:
    """who, age: the age of a reader's vocabulary from right and wrong answers. answers: who, age (of the word), right.

    The third-highest age answered rightly, or the one that as many wrong answers leave, and the second-lowest answered wrongly, which
    counts twice; few right answers lower it, few wrong ones raise it; from 3 to 20.
    """
    good = F.sort_array(F.collect_list(F.when(F.col("right"), F.col("age"))), False)
    bad = F.sort_array(F.collect_list(F.when(~F.col("right"), F.col("age"))))
    a = answers.groupBy("who").agg(good.alias("good"), bad.alias("bad")).withColumns({"n": F.size("good"), "m": F.size("bad")})
    at = F.least(F.least(F.lit(2), F.col("m") + 1), F.col("n") - 1)
    best = F.when(F.col("n") > 0, F.get("good", at) - F.when(F.col("n") < 3, 3 - F.col("n")).otherwise(0)).otherwise(0.0)
    worst = F.get("bad", F.least(F.lit(1), F.col("m") - 1)) - F.when(F.col("m") >= 3, 0.5).otherwise(0.0)
    age = F.when(F.col("m") > 0, (best * F.col("n") + worst * F.col("m") * 2) / (F.col("n") + F.col("m") * 2)).otherwise(best) + F.when(F.col("m") == 0, 0.5).when(F.col("m") <= 1, 0.25).otherwise(0.0)
    return a.select("who", F.least(F.greatest(F.bround(age), F.lit(3.0)), F.lit(20.0)).cast("int").alias("age"))


def plain_sound(pronunciation: Column) -> Column:
    """A pronunciation in the signs of one convention: brackets round, length marks, no dots between syllables."""
    p = F.regexp_replace(pronunciation, r"^\[([^\]]+)\]$", "$1")
    p = F.regexp_replace(F.regexp_replace(p, r"\[(.*?)\]", "($1)"), "⟨(.*?)⟩", "$1")
    return F.regexp_replace(F.regexp_replace(p, ":", "ː"), "·", "")


def symbol_samples(prons: DataFrame, least: int = 10, samples: int = 10) -> DataFrame:
    """symbol, n, words: signs of pronunciations that occur at least `least` times, with their first words by score.

    prons: word, sound, score. Optional parts in brackets don't count, nor does 'the'; each occurrence counts.
    """
    bare = F.regexp_replace("sound", r"\(.*?\)", "")
    each = prons.where("word != 'the'").select("word", F.round("score", 12).alias("score"), "sound", F.explode(F.split(bare, "")).alias("symbol")).where("symbol != ''")
    counts = each.groupBy("symbol").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    by = Window.partitionBy("symbol").orderBy(F.desc("score"), "word", "sound")
    first = each.withColumn("r", F.row_number().over(by)).where(F.col("r") <= samples)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("r", "word"))), lambda x: x["word"])
    return counts.join(first.groupBy("symbol").agg(F.array_join(ordered, "\t").alias("words")), "symbol")


def optional_homophones(prons: DataFrame) -> DataFrame:
    """sound, n, words: words of one sound, stress aside, where optional parts in brackets may be spoken or not. prons: word, sound."""
    bare = lambda c: F.regexp_replace(c, "[ˈˌ. ]", "")
    forms = F.array_distinct(F.array(bare(F.regexp_replace("sound", r"\((.*?)\)", "$1")), bare(F.regexp_replace("sound", r"\(.*?\)", ""))))
    each = prons.select("word", F.explode(forms).alias("sound")).where("sound != ''").distinct()
    return each.groupBy("sound").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("word")), "\t").alias("words")).where("n > 1")


def choose_readings(readings: DataFrame, by_length: bool = False) -> DataFrame:
    """word, reading: the reading told most often; of equals the first told, or with `by_length` the shortest. readings: word, at, reading."""
    told = readings.groupBy("word", "reading").agg(F.count("*").alias("n"), F.max("at").alias("last"), F.min("at").alias("at"))
    tie = F.char_length("reading") if by_length else F.col("at")
    return told.groupBy("word").agg(F.min_by("reading", F.struct(-F.col("n"), tie, "reading")).alias("reading"))


def inflection_idf(prob: Column) -> Column:
    """The idf of a headword as exported with its inflections."""
    return F.when(prob > F.exp(F.lit(-20.0)), F.format_string("%.3f", -F.log(prob))).otherwise("20")


def sense_votes(votes: DataFrame) -> DataFrame:
    """word, synset, score: votes relative to the greatest of the word, raised by the number of senses voted on. votes: word, synset, score."""
    told = votes.where("score >= 0")
    part = Window.partitionBy("word")
    n, most = F.count("*").over(part), F.max("score").over(part)
    scored = told.withColumn("most", most).withColumn("n", n).where("most > 0 and score > 0")
    return scored.select("word", "synset", (F.col("score") / F.col("most") * F.greatest(F.lit(1.0), F.log(F.col("n") + 1.0))).alias("score"))


def reverse_senses(queries: DataFrame, senses: DataFrame) -> DataFrame:
    """qid, key, score, place: headwords with a sense of exactly that translation, by its score or the headword's. senses: key, score,
    translation, translation_score (or null)."""
    met = queries.join(senses, F.lower("translation") == F.col("q")).groupBy("qid", "key").agg(F.max(F.greatest("score", F.coalesce("translation_score", F.lit(0.0)))).alias("score"))
    return met.withColumn("place", F.row_number().over(Window.partitionBy("qid").orderBy(F.round("score", 12).desc(), "key")))


def shared_translations(pairs: DataFrame, translations: DataFrame) -> DataFrame:
    """a, b, n: how many translations two headwords have in common, of those that have any. pairs: a, b; translations: key, translation."""
    mine = translations.withColumnRenamed("key", "a")
    theirs = translations.withColumnRenamed("key", "b")
    return pairs.distinct().join(mine, "a").join(theirs, ["b", "translation"]).groupBy("a", "b").agg(F.count("*").alias("n"))


def keyword_spans(sentences: DataFrame, keywords: DataFrame, longest: int) -> DataFrame:
    """id, phrase: the keywords in sentences, also those longer than the n-grams that are indexed. sentences: id, words."""
    grams = sentences.select("id", F.explode(F.array_distinct(ngrams(F.col("words"), longest))).alias("phrase"))
    return grams.join(keywords.select(F.col("key").alias("phrase")).distinct(), "phrase", "left_semi").select("id", "phrase")


def posted_sentences(queries: DataFrame, postings: DataFrame, sentences: DataFrame) -> DataFrame:
    """qid, id and the sentences' other columns, of the sentences posted under a phrase. postings: phrase, ids; sentences: id and more."""
    found = queries.join(postings, queries["q"] == postings["phrase"]).select("qid", F.explode("ids").alias("id")).distinct()
    return found.join(sentences, "id")


def inversion_ladder(rows: DataFrame, told: DataFrame) -> DataFrame:
    """translation, key, score, tran_prob: a dictionary turned round, each headword's translations taken as far as they are likely.

    rows: key, place (from 0), translation, prob, tran_prob; told: key, translation (given by supplements). The first translation is
    taken always, the second from a likelihood of 0.01 on, the third from 0.02, the fourth from 0.04, any from 0.1, and the first two
    that a supplement has. The score adds the headword's probability, the place, the likelihood and the supplement.
    """
    marked = rows.where(F.col("translation") != F.col("key")).join(told.select("key", "translation").distinct().withColumn("told", F.lit(True)), ["key", "translation"], "left")
    place, p, held = F.col("place"), F.col("tran_prob"), F.col("told").isNotNull()
    taken = (place == 0) | ((place <= 1) & (p >= 0.01)) | ((place <= 2) & (p >= 0.02)) | ((place <= 3) & (p >= 0.04)) | (p >= 0.1) | (held & (place <= 1))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("place")) - 1
    score = F.greatest(F.lit(0.1), F.sqrt("prob")) + 0.5 * F.pow(F.lit(0.8), rank.cast("double")) + F.pow(p, F.lit(0.75)) + F.when(held, 0.1).otherwise(0.0)
    return marked.where(taken).withColumn("score", score).select("translation", "key", "score", "tran_prob")


def word_relations(forms: DataFrame, edges: DataFrame, synonyms: DataFrame) -> DataFrame:
    """key, forms, parents, children, synonyms: what is related to a headword, each list parted by commas, synonyms by weight.

    synonyms: key, at (order in which they were told), synonym; each told one weighs 0.98 of the one before, repeated ones add up.
    """
    listed = lambda df, by, member, name: df.groupBy(F.col(by).alias("key")).agg(F.array_join(F.array_sort(F.collect_set(member)), ",").alias(name))
    weight = F.pow(F.lit(0.98), (F.row_number().over(Window.partitionBy("key").orderBy("at", "synonym")) - 1).cast("double"))
    voted = synonyms.where("synonym != key").withColumn("w", weight).groupBy("key", "synonym").agg(F.sum(F.round("w", 9)).alias("w"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.round("w", 9)).alias("w"), "synonym")))
    by_weight = voted.groupBy("key").agg(F.array_join(F.transform(ordered, lambda x: x["synonym"]), ",").alias("synonyms"))
    parts = [listed(forms, "key", "form", "forms"), listed(edges, "child", "parent", "parents"), listed(edges, "parent", "child", "children"), by_weight]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, "key", "full")
    return out.select("key", *(F.coalesce(c, F.lit("")).alias(c) for c in ("forms", "parents", "children", "synonyms")))


def synset_feedback(rows: DataFrame) -> DataFrame:
    """key, synset, translations (array, each once in order): what senses say of their synset's translations. rows: key, text."""
    synset = F.regexp_extract("text", r"\[synset\]: ([-0-9a-z]+)", 1)
    told = F.regexp_replace(F.regexp_extract("text", r"\[translation\]: ([^\[]+)", 1), r"\([^)]+\)", "")
    members = F.array_distinct(F.filter(F.transform(F.split(told, ","), trim), lambda t: t != ""))
    return rows.select("key", synset.alias("synset"), members.alias("translations")).where((F.col("synset") != "") & (F.size("translations") > 0))


def merge_items(items: DataFrame, least: int = 4, middle: int = 6, most: int = 12, alike: float = 0.3) -> DataFrame:
    """key, at, text, aux of the glosses that an entry shows: those of its best source, up to `most`; if they are fewer than `least`,
    others while they are fewer than `middle`, unless their n-grams are those of glosses shown. items: key, at, main (boolean), text, words.

    What is held of one entry is `most` of its main glosses and 4 x `most` of the others, so no entry fills a task.
    """
    by = Window.partitionBy("key", "main").orderBy("at")
    near = items.withColumn("r", F.row_number().over(by)).where(F.col("r") <= F.when(F.col("main"), most).otherwise(4 * most))
    grouped = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct((~F.col("main")).alias("aux"), "at", "text", "words"))).alias("all"))
    main, rest = F.filter("all", lambda x: ~x["aux"]), F.filter("all", lambda x: x["aux"])
    texts = F.transform(main, lambda x: x["words"])
    grams = lambda w: [F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))) for n in (1, 2, 3)]
    count = lambda xs, g: F.size(F.filter(xs, lambda x: x == g))

    def precision(w: Column) -> Column:
        parts, orders = [], F.least(F.size(w), F.lit(3))
        for n, own in enumerate(grams(w)):
            clip = F.aggregate(F.array_distinct(own), F.lit(0), lambda acc, g: acc + F.least(count(own, g), F.coalesce(F.array_max(F.transform(texts, lambda t: F.coalesce(count(grams(t)[n], g), F.lit(0)))), F.lit(0))))
            parts.append(F.coalesce(clip / F.size(own), F.lit(0.0)))
        return (parts[0] + parts[1] + parts[2]) / orders

    fresh = F.filter(rest, lambda x: (F.size(main) == 0) | ((F.size(x["words"]) > 0) & (precision(x["words"]) < alike)))
    extra = F.when(F.size(main) < least, F.slice(fresh, F.lit(1), F.greatest(F.lit(middle) - F.size(main), F.lit(0)))).otherwise(F.slice(fresh, F.lit(1), F.lit(0)))
    return grouped.select("key", F.explode(F.concat(main, extra)).alias("x")).select("key", "x.at", "x.text", "x.aux")
