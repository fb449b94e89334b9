"""Enrichment and selection on small frames, with results worked out by hand or by plain Python."""

from pyspark.sql import functions as F

from lexloom.operators import enrich, examples, lexicon, selection


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_idioms(spark):
    entry = spark.createDataFrame([("take", 1e-3, 4, True), ("off", 1e-2, 1, False), ("take off", 1e-4, 1, True), ("one time", 1e-5, 1, False), ("time", 1e-3, 2, False)], "key string, prob double, n_items int, moving boolean")
    assert rows(enrich.idioms(entry)) == {("take", 1, "take off"), ("off", 1, "take off"), ("time", 1, "one time")}
    assert rows(enrich.pivot_tokens(entry)) == {("take off", "take")}
    assert enrich.idioms(entry.limit(0)).count() == 0


def test_related(spark):
    told = [("a", "b", "synonym", "x", 0), ("a", "b", "synonym", "x", 5), ("a", "b", "antonym", "y", 0), ("a", "c", "hypernym", "x", 0), ("a", "d", "synonym", "x", 0), ("a", "a", "synonym", "x", 0), ("a", "zz", "synonym", "x", 0)]
    relations = spark.createDataFrame(told, "key string, rel string, kind string, label string, place int")
    entry = spark.createDataFrame([(k, 1e-3, 4) for k in "abcd"], "key string, prob double, n_items int")
    family = spark.createDataFrame([("a", "d")], "child string, parent string")
    assert rows(enrich.related(relations, entry, family)) == {("a", 1, "b"), ("a", 2, "c")}


def test_phrasal_inflections_and_coocs(spark):
    verbs = spark.createDataFrame([("take",), ("take off",), ("off",)], "key string")
    forms = spark.createDataFrame([("take", "past", "took"), ("take", "ing", "taking")], "key string, form string, value string")
    assert rows(enrich.phrasal_inflections(verbs, forms)) == {("take off", "past", "took off"), ("take off", "ing", "taking off")}
    entry = spark.createDataFrame([("dog",), ("cat",), ("bone",), ("the",)], "key string")
    coocs = spark.createDataFrame([("dog", "cat", 0.2, 1), ("dog", "bone", 0.1, 2), ("dog", "tail", 0.5, 3)], "word string, cooc string, prob double, rank int")
    probs = spark.createDataFrame([("dog", 1e-3), ("cat", 1e-3), ("bone", 1e-5), ("the", 0.1), ("tail", 1e-4)], "word string, prob double")
    told = spark.createDataFrame([("dog", "wn", ["the", "bone"])], "key string, label string, words array<string>")
    assert rows(enrich.word_coocs(entry, coocs, probs, told)) == {("dog", 1, "bone"), ("dog", 2, "cat")}


def test_targets(spark):
    table = [("Run", 3, 10, "走る", 0.5, 0.5), ("run", 30, 10, "走る", 0.5, 0.3), ("run", 30, 10, "する", 0.9, 0.9), ("run", 30, 10, "走", 0.6, 0.6), ("run", 30, 10, "を走", 0.9, 0.9), ("run", 30, 10, "run時", 0.9, 0.9), ("run", 30, 10, "稀", 0.1, 0.1)]
    df = spark.createDataFrame(table, "src string, cnt long, n long, trg string, ef double, fe double")
    assert rows(enrich.select_targets(df)) == {("run", 1, "走る")}
    pairs = spark.createDataFrame([("a", "語", 10), ("a", "単語", 9), ("a", "これ 語", 9), ("a", "、", 99)], "src string, trg string, cnt long")
    assert [r.trg for r in enrich.top_targets(pairs).orderBy("place").collect()] == ["これ 語", "単語", "語"]


def test_compensation_and_minor_translations(spark):
    entry = spark.createDataFrame([("dog",), ("cat",)], "key string")
    t = spark.createDataFrame([("dog", "犬")], "key string, translation string")
    turned = spark.createDataFrame([("犬", ["cat"]), ("猫", ["kitty", "cat", "dog"]), ("鳥", ["bird"])], "translation string, words array<string>")
    assert rows(enrich.compensate_reverse(entry, t, turned)) == {("cat", "猫")}
    minor = spark.createDataFrame([("dogg", "dog", "犬"), ("dogg", "dog", "番犬"), ("dogg", "dog", "狗")], "key string, main string, translation string")
    told = spark.createDataFrame([("dogg", "番犬")], "key string, translation string")
    assert rows(enrich.without_main_translations(minor, t, told)) == {("dogg", "dog", "番犬"), ("dogg", "dog", "狗")}


def test_keep_entries_and_ladder(spark):
    items = spark.createDataFrame([("研究", "study", 0.3), ("研究する", "study", 0.3), ("研究する", "do", 0.01), ("調査する", "study", 0.3), ("調査", "study", 0.21), ("稀", "rare", 0.0)], "translation string, key string, tran_prob double")
    none = spark.createDataFrame([], "translation string, prob double")
    phrases = spark.createDataFrame([("study", 1e-3)], "key string, prob double")
    got = rows(selection.keep_entries(items, none, phrases, none.select("translation")))
    assert got == {("研究", "translation"), ("研究する", "translation"), ("調査する", "affix"), ("調査", "translation"), ("稀", "dropped")}
    ladder = spark.createDataFrame([("k", i, t, 1e-4, p) for i, (t, p) in enumerate([("a", 0.0), ("b", 0.005), ("c", 0.03), ("d", 0.03), ("e", 0.2)])], "key string, place int, translation string, prob double, tran_prob double")
    told = spark.createDataFrame([("k", "b"), ("k", "d")], "key string, translation string")
    assert {r.translation for r in selection.inversion_ladder(ladder, told).collect()} == {"a", "b", "c", "e"}


def test_quiz(spark):
    answers = [(1, 10.0, True), (1, 12.0, True), (1, 9.0, True), (1, 5.0, True), (1, 11.0, False), (1, 15.0, False), (2, 8.0, False), (3, 7.0, True)]
    got = rows(selection.vocabulary_age(spark.createDataFrame(answers, "who int, age double, right boolean")))
    # 1: third of 12, 10, 9, 5 is 9; second wrong 15: (9 * 4 + 15 * 4) / 8 = 12; 2: 8 alone, +0.25; 3: 7 - 2 + 0.5
    assert got == {(1, 12), (2, 8), (3, 6)}
    ranks = spark.range(1, 1001).select(F.col("id").alias("rank"))
    assert selection.rank_window(ranks, 20).count() == 99 and selection.rank_window(ranks, 500).agg(F.min("rank")).first()[0] == 250
    assert tuple(spark.range(1).select(*selection.level_ranks(F.lit(2))).first()) == (1500, 4761)


def test_items_and_duplicates(spark):
    items = [("k", 1, True, "a", "a red dog".split()), ("k", 2, False, "b", "a red dog".split()), ("k", 3, False, "c", "some other thing here".split()), ("k", 4, False, "d", [])]
    df = spark.createDataFrame(items, "key string, at int, main boolean, text string, words array<string>")
    assert {(r.text, r.aux) for r in selection.merge_items(df).collect()} == {("a", False), ("c", True)}
    pairs = spark.createDataFrame([(1, "A b", "x"), (2, "a B", "y"), (3, "c", "X"), (4, "d", "z")], "id int, source string, target string")
    assert {(r.id, r.duplicate) for r in examples.duplicated(pairs).collect()} == {(1, None), (2, "source"), (3, "target"), (4, None)}


def test_thesaurus(spark):
    rows_ = spark.createDataFrame([(k, t) for k in ("k1", "k2") for t in ("甲", "乙")] + [("k1", "丙"), ("k3", "丙")], "key string, translation string")
    pairs = lexicon.co_translations(rows_)
    assert rows(pairs) == {("乙", "甲", 2)}
    assert rows(lexicon.thesaurus(pairs)) == {("甲", 1, "乙"), ("乙", 1, "甲")}
