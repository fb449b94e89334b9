"""The search layer in batch form: a frame of queries is joined with the keys, never looped over.

queries: qid, q (key form). keys: key, rank. Each search is an equi-join on something the match implies, then the exact test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_word, predict_language
from ..runtime import bounded, cut


def top(found: DataFrame, capacity: int | None, *order: str) -> DataFrame:
    """The first `capacity` matches of each query."""
    if capacity is None:
        return found
    by = Window.partitionBy("qid").orderBy(*order)
    return found.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= capacity).drop("_r")


def exact(queries: DataFrame, keys: DataFrame) -> DataFrame:
    """Matches of each member of a comma-separated query."""
    each = queries.select("qid", F.explode(F.split("q", ",")).alias("key")).select("qid", F.trim("key").alias("key")).where("key != ''").distinct()
    return each.join(keys, "key").select("qid", "key", "rank")


def begins(queries: DataFrame, keys: DataFrame, capacity: int | None = None, size: int = 3) -> DataFrame:
    """Keys that begin with the query; both meet on their first letters, shorter queries on all of theirs."""
    heads = keys.select("key", "rank", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(size), F.char_length("key"))), lambda n: F.struct(n.alias("n"), F.left("key", n).alias("g")))).alias("h"))
    asked = queries.where("q != ''").select("qid", "q", F.least(F.lit(size), F.char_length("q")).alias("n")).withColumn("g", F.left("q", "n"))
    found = heads.select("key", "rank", "h.n", "h.g").join(asked, ["n", "g"]).where(F.startswith("key", "q"))
    return top(found.select("qid", "key", "rank"), capacity, "rank")


def ends(queries: DataFrame, keys: DataFrame, capacity: int | None = None) -> DataFrame:
    """Keys that end with the query: beginnings of reversed words."""
    turned = begins(queries.withColumn("q", F.reverse("q")), keys.withColumn("key", F.reverse("key")))
    return top(turned.withColumn("key", F.reverse("key")), capacity, "rank")


def contains(queries: DataFrame, keys: DataFrame, capacity: int | None = None, size: int = 3) -> DataFrame:
    """Keys that contain the query; both meet on the query's first letters anywhere in the key."""
    grams = keys.select("key", "rank", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("n")).where(F.char_length("key") >= F.col("n"))
    grams = grams.select("key", "rank", "n", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length("key") - F.col("n") + 1), lambda i: F.substring("key", i, F.col("n"))))).alias("g"))
    asked = queries.where("q != ''").select("qid", "q", F.least(F.lit(size), F.char_length("q")).alias("n")).withColumn("g", F.left("q", "n"))
    found = grams.join(asked, ["n", "g"]).where(F.contains("key", "q"))
    return top(found.select("qid", "key", "rank"), capacity, "rank")


def words(queries: DataFrame, keys: DataFrame, capacity: int | None = None) -> DataFrame:
    """Keys that have the query as whole words in a row; both meet on the query's first word."""
    parts = keys.select("key", "rank", F.explode(F.array_distinct(F.split("key", "[ -]"))).alias("w"))
    asked = queries.where("q != ''").select("qid", "q", F.element_at(F.split("q", "[ -]"), 1).alias("w"))
    pad = lambda c: F.concat(F.lit(" "), F.translate(c, "-", " "), F.lit(" "))
    found = parts.join(asked, "w").where(F.contains(pad("key"), pad("q")))
    return top(found.select("qid", "key", "rank"), capacity, "rank")


def edits(queries: DataFrame, keys: DataFrame, most: int = 2, capacity: int | None = None) -> DataFrame:
    """Keys within `most` edits: qid, key, rank, distance.

    A query is cut into most + 1 segments; with at most `most` edits one of them stands unchanged in the key, shifted by no
    more. So both meet on (length of the query, segment number, segment), and only then the distance is computed. Queries too
    short to be cut meet all keys of about their length, on that length alone.
    """
    parts = most + 1
    asked = queries.where("q != ''").withColumn("len", F.char_length("q"))
    base, extra = F.floor(F.col("len") / parts).cast("int"), (F.col("len") % parts).cast("int")
    number = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("i")
    start = lambda i: base * i + F.greatest(i - (F.lit(parts) - extra), F.lit(0)) + 1
    size = lambda i: base + F.when(i >= F.lit(parts) - extra, 1).otherwise(0)
    cut = asked.where(F.col("len") >= parts).select("qid", "q", "len", number).withColumn("seg", F.substring("q", start(F.col("i")).cast("int"), size(F.col("i")).cast("int")))
    around = keys.withColumn("klen", F.char_length("key")).select("key", "rank", "klen", F.explode(F.sequence(F.greatest(F.col("klen") - most, F.lit(1)), F.col("klen") + most)).alias("len"))
    placed = around.where(F.col("len") >= parts).select("key", "rank", "klen", "len", number)
    shifts = placed.withColumn("s", F.explode(F.sequence(F.lit(-most), F.lit(most)))).withColumn("at", (start(F.col("i")) + F.col("s")).cast("int")).where((F.col("at") >= 1) & (F.col("at") + size(F.col("i")) - 1 <= F.col("klen")))
    pieces = shifts.select("key", "rank", "len", "i", F.substring("key", F.col("at"), size(F.col("i")).cast("int")).alias("seg")).distinct()
    met = pieces.join(cut, ["len", "i", "seg"]).select("qid", "q", "key", "rank")
    short = asked.where(F.col("len") < parts).join(around, "len").select("qid", "q", "key", "rank")
    found = met.unionByName(short).distinct().withColumn("distance", F.levenshtein("q", "key", most)).where("distance >= 0")
    return top(found.select("qid", "key", "rank", "distance"), capacity, "distance", "rank")


def reverse(queries: DataFrame, index: DataFrame, capacity: int | None = None) -> DataFrame:
    """Headwords by translation: qid, key, score. index: translation, key, score."""
    found = queries.join(index, queries["q"] == index["translation"]).select("qid", "key", "score")
    return top(found.withColumn("minus", -F.round("score", 12)), capacity, "minus", "key").drop("minus") if capacity else found


def inflected(queries: DataFrame, keys: DataFrame, index: DataFrame) -> DataFrame:
    """Headwords of a form: itself first (place 0), then those that inflect to it, by score: qid, key, place."""
    own = queries.join(keys, queries["q"] == keys["key"]).select("qid", "key", F.lit(0).alias("place"))
    by = Window.partitionBy("qid").orderBy(F.round("score", 12).desc(), "key")
    bases = queries.join(index, queries["q"] == index["form"]).where("key != q").select("qid", "key", "score").withColumn("place", F.row_number().over(by)).select("qid", "key", "place")
    return own.unionByName(bases)


def partial(queries: DataFrame, keys: DataFrame) -> DataFrame:
    """Headwords among the parts of one and two words less of queries of two to six words: qid, key, start, n.

    A part ends before the query does, so the last words alone are none.
    """
    w = queries.select("qid", F.split("q", " ").alias("w")).where(F.size("w").between(2, 6))
    lengths = w.select("qid", "w", F.explode(F.array(F.size("w") - 1, F.size("w") - 2)).alias("n")).where("n > 0")
    parts = lengths.select("qid", "n", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("n") - 1)).alias("start"), "w")
    named = parts.select("qid", "n", "start", F.array_join(F.slice("w", F.col("start") + 1, F.col("n")), " ").alias("key"))
    return named.join(keys.select("key"), "key").select("qid", "key", "start", "n")


# Words that set phrases generalise or leave out.
PARTICLES = (
    "aback about above abroad across after against ahead along amid among apart around as at away back before behind below beneath between beside beyond by despite during down except "
    "for forth from in inside into near of off on onto out outside over per re since than through throughout till to together toward under until up upon with within without via"
).split()
POSSESSIVES = "my our your his her its their".split()
REFLEXIVES = "myself ourselves yourself yourselves himself herself itself theirselves".split()
OBJECTS = "me us you him her it them this these that those mine ours yours his its theirs".split()
DETERMINERS = "a an the my our your his her its their this these that those".split()


def set_phrase_forms(q: Column) -> Column:
    """A query as dictionaries put set phrases, in order: the particle drawn to a shorter head; 'one's', 'oneself', 'someone' and
    'something' for possessives, reflexives and objects; a noun with its determiner as 'someone' or 'something'."""
    w = F.split(q, " ")
    size, none = F.size(w), F.array().cast("array<string>")
    join = lambda *parts: F.array_join(F.filter(F.concat(*parts), lambda x: x != ""), " ")
    places = F.sequence(F.lit(1), size)
    put = lambda i, by: join(F.slice(w, F.lit(1), i - 1), F.array(by), F.slice(w, i + 1, size))
    at = lambda kinds: F.filter(places, lambda i: kinds(F.get(w, i - 1)))
    owned = at(lambda x: x.isin(POSSESSIVES) | x.rlike("^[A-Za-z]+'s$"))
    own = at(lambda x: x.isin(REFLEXIVES))
    other = at(lambda x: x.isin(OBJECTS + REFLEXIVES))
    short = F.transform(F.reverse(F.sequence(F.lit(1), F.greatest(size - 2, F.lit(1)))), lambda n: join(F.slice(w, F.lit(1), n), F.array(F.get(w, size - 1))))
    both = lambda i: F.array(put(i, F.lit("someone")), put(i, F.lit("something")))
    noun = F.array(*(join(F.slice(w, 1, 1), F.array(F.lit(x)), F.slice(w, F.lit(4), size)) for x in ("someone", "something")))
    return F.array_distinct(F.concat(
        F.when(size.between(3, 5) & F.get(w, size - 1).isin(PARTICLES), short).otherwise(none),
        F.when(size.between(2, 5), F.concat(F.transform(owned, lambda i: put(i, F.lit("one's"))), F.transform(own, lambda i: put(i, F.lit("oneself"))), F.flatten(F.transform(other, both)))).otherwise(none),
        F.when((size >= 4) & F.get(w, F.lit(1)).isin(DETERMINERS), noun).otherwise(none),
    ))


def set_phrases(queries: DataFrame, keys: DataFrame) -> DataFrame:
    """Headwords that are a query's set phrase: qid, key, place (from 0)."""
    each = queries.select("qid", F.posexplode(set_phrase_forms(F.col("q"))).alias("place", "key"))
    return each.join(keys.select("key"), "key").groupBy("qid", "key").agg(F.min("place").alias("place"))


def matching(patterns: list[str], keys: DataFrame, capacity: int | None = None) -> DataFrame:
    """qid (the pattern's number), key, rank: keys that a pattern matches. All patterns are tried in one pass over the keys."""
    hits = F.array_compact(F.array(*(F.when(F.col("key").rlike(p), F.lit(n)) for n, p in enumerate(patterns))))
    return top(keys.select(F.explode(hits).alias("qid"), "key", "rank"), capacity, "rank")


def in_context(spans: DataFrame, keys: DataFrame, lemmas: DataFrame, reach: int = 3) -> DataFrame:
    """Headwords, set phrases included, that hold a word or one of its lemmas with up to `reach` words on either side: qid, key.

    spans: qid, words, at (from 0). lemmas: form, key.
    """
    core = F.get("words", F.col("at"))
    own = spans.select("qid", "words", "at", core.alias("core"))
    more = own.join(lemmas.withColumnRenamed("key", "lemma"), own["core"] == lemmas["form"]).select("qid", "words", "at", F.col("lemma").alias("core"))
    step = F.explode(F.sequence(F.lit(0), F.lit(reach)))
    grid = own.unionByName(more).distinct().withColumn("a", step).withColumn("b", step)
    inside = grid.where((F.col("at") - F.col("a") >= 0) & (F.col("at") + F.col("b") < F.size("words")))
    parts = F.concat(F.slice("words", F.col("at") - F.col("a") + 1, F.col("a")), F.array("core"), F.slice("words", F.col("at") + 2, F.col("b")))
    asked = inside.select("qid", F.array_join(parts, " ").alias("q")).distinct()
    plain = asked.withColumnRenamed("q", "key").join(keys.select("key"), "key").select("qid", "key")
    return plain.unionByName(set_phrases(asked, keys).select("qid", "key")).distinct()


def reverse_containing(queries: DataFrame, index: DataFrame, translations: DataFrame, capacity: int | None = None) -> DataFrame:
    """Headwords by translation, for queries of several words parted by commas: qid, key, score.

    The index (translation, key, score) gives the candidates; one stays if any of its translations or of its phrases' (key,
    translation, in key form) contains a word of the query.
    """
    words = queries.select("qid", F.explode(F.array_distinct(F.transform(F.split("q", ","), lambda x: F.trim(x)))).alias("w")).where("w != ''")
    found = words.join(index, words["w"] == index["translation"]).groupBy("qid", "key").agg(F.max("score").alias("score"))
    asked = found.join(words, "qid")
    held = asked.join(translations, "key").where(F.contains("translation", "w")).groupBy("qid", "key").agg(F.max("score").alias("score"))
    return top(held.withColumn("minus", -F.round("score", 12)), capacity, "minus", "key").drop("minus")


def dispatch(queries: DataFrame, keys: DataFrame, index: DataFrame, translations: DataFrame, capacity: int = 100, longest: int = 48) -> DataFrame:
    """qid, step, key, place, view: each query answered by the first way that finds anything.

    Latin queries: exact, set-phrase, partial, edit. Japanese ones: reverse, reverse-edit. Queries of more than `longest` characters
    are for annotation and have no row. The view is 'full' for one headword, 'simple' below six, else 'list'.
    """
    asked = cut(queries.where((F.col("q") != "") & (F.char_length("q") <= longest)).withColumn("ja", predict_language(F.col("q")) == "ja"))
    latin, other = asked.where("not ja").select("qid", "q"), asked.where("ja").select("qid", "q")
    answers, rest = None, latin
    near = lambda df, by: edits(df, by, capacity=capacity).select("qid", "key", (F.col("distance") * 1_000_000_000 + F.col("rank")).alias("o"))
    tran_keys = index.groupBy(F.col("translation").alias("key")).agg(F.sum("score").alias("s")).select("key", F.lit(0).alias("rank"))

    def turned(df: DataFrame) -> DataFrame:
        close = edits(df, tran_keys).select("qid", F.col("key").alias("q"), "distance")
        return close.join(index, close["q"] == index["translation"]).groupBy("qid", "key").agg(F.min(F.struct("distance", -F.round("score", 12))).alias("o"))

    ways = [
        ("exact", lambda df: exact(df, keys).select("qid", "key", F.col("rank").alias("o"))),
        ("set-phrase", lambda df: set_phrases(df, keys).select("qid", "key", F.col("place").alias("o"))),
        ("partial", lambda df: partial(df, keys).groupBy("qid", "key").agg(F.min(-F.col("n") * 10 + F.col("start")).alias("o"))),
        ("edit", lambda df: near(df, keys)),
    ]
    back = [
        ("reverse", lambda df: reverse_containing(df, index, translations).select("qid", "key", (-F.round("score", 12)).alias("o"))),
        ("reverse-edit", turned),
    ]
    for start, steps in ((latin, ways), (other, back)):
        rest = start
        for name, way in steps:
            by = Window.partitionBy("qid").orderBy("o", "key")
            got = cut(way(rest).withColumn("place", F.row_number().over(by)).where(F.col("place") <= capacity).select("qid", F.lit(name).alias("step"), "key", "place"))
            answers = got if answers is None else answers.unionByName(got)
            rest = cut(rest.join(got.select("qid").distinct(), "qid", "left_anti"))
    n = F.count("*").over(Window.partitionBy("qid"))
    return answers.withColumn("view", F.when(n < 2, "full").when(n < 6, "simple").otherwise("list"))


def popup(queries: DataFrame, keys: DataFrame, lemmas: DataFrame, capacity: int = 10) -> DataFrame:
    """qid, key, place: what a pop-up shows of a Latin query: the headword, its lemmas, and the nearest headwords if there is neither."""
    found = cut(inflected(queries, keys, lemmas).join(keys.select("key"), "key", "left_semi"))
    left = queries.join(found.select("qid").distinct(), "qid", "left_anti")
    by = Window.partitionBy("qid").orderBy("distance", "rank")
    near = edits(left, keys, capacity=capacity).select("qid", "key", F.row_number().over(by).alias("place"))
    return found.where(F.col("place") <= capacity).select("qid", "key", "place").unionByName(near)


def phrase_hits(sentences: DataFrame, entry: DataFrame, longest: int = 4) -> DataFrame:
    """Headwords that start at each word of a sentence: id, sent_id, at, n, key, score.

    sentences: id, sent_id, words (key form); entry (materialised): key, prob, n_items, n_labels. The score prefers probable,
    well-described and long headwords. Only grams travel, and those only if the headwords are too many to be broadcast.
    """
    size = F.size("words")
    at_each = F.transform(F.sequence(F.lit(0), size - 1), lambda at: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), size - at)), lambda n: F.struct(at.alias("at"), n.alias("n"), F.array_join(F.slice("words", at + 1, n), " ").alias("key"))))
    grams = sentences.where(size > 0).select("id", "sent_id", F.explode(F.flatten(at_each)).alias("g")).select("id", "sent_id", "g.at", "g.n", "g.key")
    value = F.least(F.lit(0.05), F.greatest(F.sqrt("prob"), F.lit(1e-5))) * 20 * F.log2(F.col("n_items") + 1.0) * (F.col("n_labels") + 1.0) * F.pow(F.lit(10.0), (F.col("n") - 1).cast("double"))
    return grams.join(bounded(entry), "key").select("id", "sent_id", "at", "n", "key", value.alias("score"))


def coverage(sentences: DataFrame, annotated: DataFrame) -> DataFrame:
    """id, n_words, n_annotated, coverage: how many of a document's words are within a headword."""
    total = sentences.groupBy("id").agg(F.sum(F.size("words")).alias("n_words"))
    held = annotated.select("id", "sent_id", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("at")).distinct().groupBy("id").agg(F.count("*").alias("n_annotated"))
    both = total.join(held, "id", "left").withColumn("n_annotated", F.coalesce("n_annotated", F.lit(0)))
    return both.withColumn("coverage", F.when(F.col("n_words") > 0, F.col("n_annotated") / F.col("n_words")).otherwise(0.0))


# What contractions stand for, and the stems that 'not' has been drawn to.
CONTRACTED = {"ve": ["have"], "d": ["would", "have"], "ll": ["will"], "m": ["be"], "re": ["be"], "em": ["them"]}
DRAWN_TO_NOT = {"wo": "will", "ca": "can", "sha": "shall"}


def _variants(token: Column) -> Column:
    """What else a single token may be: array<struct<key, score, inflected>>; an inflected one is looked up among the forms."""
    v = lambda key, score, inflected=False: F.struct(F.lower(key).alias("key"), F.lit(score).alias("score"), F.lit(inflected).alias("inflected"))
    none = F.array().cast("array<struct<key:string,score:double,inflected:boolean>>")
    aux = r"(?i)^(.+)['’](s|ve|d|ll|m|re|em)$"
    bare, suffix = F.regexp_extract(token, aux, 1), F.lower(F.regexp_extract(token, aux, 2))
    stands = F.when((suffix == "s") & F.lower(bare).isin("it", "he", "she"), F.array(v(F.lit("be"), 0.0001)))
    for ending, words_ in CONTRACTED.items():
        stands = stands.when(suffix == ending, F.array(*(v(F.lit(w), 0.0001) for w in words_)))
    negated = F.lower(F.regexp_extract(token, r"(?i)([a-z]{2,})n['’]t$", 1))
    verb = negated
    for stem, whole in DRAWN_TO_NOT.items():
        verb = F.when(negated == stem, whole).otherwise(verb)
    plural = F.regexp_extract(token, r"(?i)([a-z]{2,}s)['’]$", 1)
    parts = F.filter(F.split(token, "-"), lambda p: p.rlike(r"\p{IsLatin}{3,}"))
    return F.concat(
        F.when(bare != "", F.concat(F.array(v(bare, 0.7), v(bare, 0.6, True)), F.coalesce(stands, none))).otherwise(none),
        F.when(negated != "", F.array(v(verb, 0.7), v(F.lit("not"), 0.0001))).otherwise(none),
        F.when(plural != "", F.array(v(plural, 0.7), v(plural, 0.7, True))).otherwise(none),
        F.when(F.instr(token, "-") > 1, F.flatten(F.transform(parts, lambda p: F.array(v(p, 0.0002), v(p, 0.0001, True))))).otherwise(none),
    )


# A word of a text, and all that lies between words.
SPAN = r"[\p{IsLatin}\d][-_'’\p{IsLatin}\d]*|[^\p{IsLatin}\d]+"


def annotate_text(texts: DataFrame, entry: DataFrame, forms: DataFrame, longest: int = 4) -> DataFrame:
    """id, at, span, n, key, score: the headwords that a word of a text and the up to three words behind it may be, scored.

    texts: id, text. at counts the text's words from 0; n the words of the headword's surface. entry (materialised): key, prob, aoa
    (or null), has_tran, n_items, n_labels, n_children, inflections (array of forms). forms: form, key. Words are parted by gaps that
    begin with a blank; a word at a sentence's head, behind a stop or a line's end, matches in lower case as well. Surfaces count in
    full, inflected ones 0.7, contracted, possessive and hyphened ones as parts; of several ways to a headword the best counts.
    """
    spans = F.regexp_extract_all("text", F.lit(SPAN), F.lit(0))
    is_word = lambda x: x.rlike(r"^[\p{IsLatin}\d]")
    each = texts.select("id", spans.alias("s")).select("id", "s", F.posexplode(F.filter(F.sequence(F.lit(1), F.size("s")), lambda i: is_word(F.get("s", i - 1)))).alias("at", "i")).where("size(s) > 0")
    gap = lambda i: F.coalesce(F.get("s", i), F.lit("."))
    head = (F.col("at") == 0) | gap(F.col("i") - 2).rlike(r"[.!?;:\n]")
    # the n-th word of a phrase is 2(n - 1) spans further on, as long as each gap begins with a blank
    free = F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.forall(F.sequence(F.lit(1), n), lambda m: (m == 1) | gap(F.col("i") + 2 * (m - 1) - 2).rlike(r"^\s")) & (F.col("i") + 2 * (n - 1) <= F.size("s")))
    text_of = lambda n: F.array_join(F.transform(F.sequence(F.lit(1), n), lambda m: F.get("s", F.col("i") + 2 * (m - 1) - 1)), " ")
    phrases = F.transform(F.filter(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.get(free, n - 1)), lambda n: F.struct(n.alias("n"), text_of(n).alias("phrase")))
    found = each.select("id", "at", F.get("s", F.col("i") - 1).alias("span"), head.alias("head"), F.explode(phrases).alias("p")).select("id", "at", "span", "head", "p.n", "p.phrase")
    own = lambda score, inflected: F.struct(normalize_word(F.col("phrase")).alias("key"), F.lit(score).alias("score"), F.lit(inflected).alias("inflected"))
    tried = F.when(F.col("n") == 1, F.concat(F.array(own(1.0, False), own(0.7, True)), _variants(F.col("phrase")))).otherwise(F.array(own(1.0, False), own(0.7, True)))
    variants = found.select("id", "at", "span", "head", "n", "phrase", F.explode(tried).alias("v")).select("id", "at", "span", "head", "n", "phrase", "v.key", "v.score", "v.inflected")
    plain = variants.where("not inflected").drop("inflected")
    words_of = lambda c: F.size(F.split(c, " "))
    looked = variants.where("inflected").withColumnRenamed("key", "form").join(forms.select("form", "key"), "form").where(words_of("key") == F.col("n")).select(*plain.columns)
    met = plain.unionByName(looked).join(bounded(entry), "key")
    lower_head = F.concat(F.lower(F.substring("phrase", 1, 1)), F.expr("substring(phrase, 2)"))
    same = lambda title: (F.col("phrase") == title) | (F.col("head") & (F.col("phrase") != "I") & (lower_head == title))
    matched = same(F.col("key")) | F.exists(F.coalesce("inflections", F.array().cast("array<string>")), same)
    aoa = F.least(F.greatest(F.coalesce("aoa", -F.log(F.col("prob") + 1e-8) + 3.5), F.lit(3.0)), F.lit(20.0))
    score = (
        F.col("score") * F.least(F.lit(0.05), F.greatest(F.sqrt("prob"), F.lit(1e-5))) * 20 * (25 - aoa) / 10 * F.when(F.col("has_tran"), 1.0).otherwise(0.5)
        * F.log2(F.col("n_items") + 1.0) * (F.col("n_labels") + 1.0) * F.log2(F.col("n_children") + 4.0) * F.when(matched, 1.0).otherwise(0.2)
        * F.pow(F.when(F.col("has_tran"), 200.0).otherwise(10.0), (words_of("key") - 1).cast("double"))
    )
    return met.withColumn("score", score).groupBy("id", "at", "span", "n", "key").agg(F.max("score").alias("score"))
