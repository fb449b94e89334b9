"""Text functions, corpus statistics and similarity against hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from lexloom.functions.phonetic import sampa_to_ipa
from lexloom.functions import text as t
from lexloom.operators import corpus, examples, features, search, similarity
from lexloom.operators import tokenize as tk
from lexloom.plans import corpus_queries, text_queries


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


def test_normalize_word(spark):
    assert one(spark, t.normalize_word(F.lit("  Crème  BRÛLÉE・x "))) == "creme bruleex"
    assert one(spark, t.normalize_word(F.lit("éガ"))) == "eガ"
    assert one(spark, t.normalize_word(F.lit(None).cast("string"))) is None


def test_weights_and_language(spark):
    rows = spark.createDataFrame([("1.5",), ("the",), ("a1",), ("cat",)], "w string")
    assert [r[0] for r in rows.select(t.word_weight(F.col("w"))).collect()] == [0.2, 0.5, 0.5, 1.0]
    assert one(spark, t.predict_language(F.lit("aガ"))) == "ja" and one(spark, t.predict_language(F.lit("a"))) == "en"
    assert one(spark, t.to_katakana(F.lit("がa"))) == "ガa" and one(spark, t.to_hiragana(F.lit("ガa"))) == "がa"


def test_deduplicate_words(spark):
    assert one(spark, t.deduplicate(F.array(*map(F.lit, ["elephant", "elephants", "cat", "Cat", "dog"])))) == ["elephant", "cat", "dog"]
    assert one(spark, t.deduplicate(F.array().cast("array<string>"))) == []


def test_edit_ratio(spark):
    assert one(spark, t.edit_ratio(F.lit("abc"), F.lit("abd"))) == pytest.approx(1 / 3)
    assert one(spark, t.edit_ratio(F.lit(""), F.lit(""))) == 0


def test_format_and_cut(spark):
    assert one(spark, t.format_prob(F.lit(0.25))) == ".2500000"
    assert one(spark, t.cut_width(F.lit("あいうえ"), 4)) == "あいう..." and one(spark, t.cut_width(F.lit("ab"), 4)) == "ab" and one(spark, t.cut_width(F.lit(""), 4)) == ""
    assert one(spark, t.words_within(F.array(*map(F.lit, ["猫", " ", "いぬ ", "cat", "x"])), 6, 2)) == ["猫", "いぬ"]
    assert one(spark, sampa_to_ipa(F.lit('"kAt_<r\\(@)'))) == "ˈkɑtɹə" and one(spark, sampa_to_ipa(F.lit("a$"))) is None


def test_plain_text(spark):
    assert one(spark, t.normalize_text(F.lit("ｆｕｌｌ ❛x❜ „y‟ ‒–⁃−➖⸺ ﬁ"))) == "full 'x' \"y\" ------ fi"
    assert one(spark, t.clean_sentence(F.lit(" ・- * a  b "))) == "* a b" and one(spark, t.clean_sentence(F.lit("-*・ x"))) == "x"
    assert one(spark, t.word_id(F.lit("ab c-d/é~%"))) == "ab_c-d/~C3~A9~~25"
    assert [one(spark, t.key_prefix(F.lit(k))) for k in ("abc", "Abc", "1", "é")] == ["a", "_", "_", "_"]
    assert [one(spark, t.is_safe_text(F.lit(k))) for k in ("a cat 猫ー。", "é", "a{b", "a\tb")] == [True, False, False, False]
    assert one(spark, t.sanitize(F.lit("a\tக😀 б猫"))) == "a □□ б猫"


def test_sentence_keys_tell_words_apart(spark):
    words = [f"w{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    keys = [r.k for r in spark.createDataFrame([(w,) for w in words], "w string").select(t.sentence_key(F.col("w")).alias("k")).collect()]
    assert all(len(k) == 1 for k in keys) and len(set(keys)) > 970
    assert len(one(spark, t.sentence_key(F.lit("Don't  stop, 12 go!")))) == 3


def test_variants_and_stems(spark):
    assert "color" in one(spark, t.spell_variants(F.lit("colour"))) and "colour" in one(spark, t.spell_variants(F.lit("color")))
    for word, other in (("colonised", "colonized"), ("organisation", "organization"), ("practice", "practise"), ("travel", "travell"), ("center", "centre"), ("catalog", "catalogue")):
        assert other in one(spark, t.spell_variants(F.lit(word))) and word in one(spark, t.spell_variants(F.lit(other)))
    assert "happy" in one(spark, t.derivative_stems(F.lit("happiness")))


def test_sentences_and_tokens(spark):
    got = one(spark, tk.sentences(F.lit("Mr. Smith of the U. S. A. came. He left? \"No.\" e.g. This。次。 ")))
    assert got == ["Mr. Smith of the U.S.A. came.", "He left?", "\"No.\" e.g. This。", "次。"]
    assert one(spark, tk.sentences(F.lit(None).cast("string"))) == []
    assert one(spark, tk.tokens(F.lit("The U.S.A. isn't -5 café, x_y!"))) == ["The", "USA", "isn't", "-5", "café", "x_y"]


def test_markup(spark):
    assert one(spark, tk.wiki_lines(F.lit("== H ==\n* [[a|b]] ''c''<ref>x</ref>\n{| t\n:Image:q\n{{x}}d"))) == ["H", "a c", "d"]
    page = "<html><head><title>T</title></head><body><h2 class='x'>A &amp; B</h2><p>c<br>d</p><script>s</script></body></html>"
    assert one(spark, tk.html_text(F.lit(page))) == "====[META]====\n[title]: T\n====[PAGE]====\n[head2]: A & B\nc\nd"
    assert one(spark, tk.cram(F.lit("a\nb\n\n c \n\n\nd"))) == "a b\nc\nd"


def test_pages(spark):
    text = "====[META]====\n[title]: t\n====[PAGE]====\na\nb\n====[PAGE]====\n====[PAGE]====\nc"
    got = tk.divide_pages(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).select("page", "line").collect()
    assert sorted(map(tuple, got)) == [(0, "[title]: t"), (1, "a"), (1, "b"), (2, "c")]


def test_source_phrases(spark):
    assert set(one(spark, tk.source_phrases(F.lit("the cat's hat, old"), 2))) == {"the", "cat", "hat", "old", "the cat", "cat hat"}


def test_domain_pairs_have_three_word_phrases(spark, tmp_path):
    rows = [(i, f"the big dog of place{i}\t犬{i}", "parallel", f"d{i}") for i in range(2)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, domain_name string").withColumn("lang", F.lit("en")).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.src: r.cnt for r in corpus_queries.domain_pairs(spark, str(tmp_path)).where("trg = '犬'").collect()}
    assert got["the big dog"] == got["big dog of"] == 2 and "the big dog of" not in got


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "The cat sat on the mat\nthe cat ran", "en"), (2, "A cat and a dog", "EN"), (3, "Dogs run", "en"), (4, None, "en"), (5, "", "en"), (6, "猫", "ja")]
    return corpus.english(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_ngram_counts(docs):
    got = {r.phrase: r.cnt for r in corpus.ngram_counts(corpus.sentence_tokens(docs, False), 2).collect()}
    assert len(got) == 27
    assert {k: got[k] for k in ("cat", "the", "the cat", "The", "The cat", "A", "A cat", "a", "dogs", "dogs run")} == {"cat": 3, "the": 2, "the cat": 2, "The": 1, "The cat": 1, "A": 1, "A cat": 1, "a": 1, "dogs": 1, "dogs run": 1}
    assert tuple(corpus.totals(corpus.sentence_tokens(docs, False)).first()) == (3, 4, 16)


def test_long_documents_count_whole(spark):
    long = spark.createDataFrame([(7, "\n".join(f"word{i} stands here" for i in range(1100)), "en")], "doc_id long, text string, lang string")
    assert tuple(corpus.totals(corpus.sentence_tokens(long, False)).first()) == (1, 1100, 3300)
    assert {r.word: r.cnt for r in corpus.word_counts(corpus.sentence_tokens(long, True)).where("word in ('stands', 'word1099')").collect()} == {"stands": 1100, "word1099": 1}
    assert tk.document_sentences(long, cap=64).count() == 64


def test_readable_documents_are_whole(spark):
    long = spark.createDataFrame([(7, "\n".join(f"Word{i} stands here in this line." for i in range(100)))], "doc_id long, text string")
    got = sorted((r.place, r.words[0]) for r in tk.readable_documents(long).collect())
    assert got == [(i, f"Word{i}") for i in range(100)]
    assert sorted(r.words[0] for r in tk.readable_documents(long, most=10).collect()) == [f"Word{i}" for i in range(36, 46)]


def test_postings_of_long_documents(spark, tmp_path):
    rows = [(1, "\n".join(["one"] * 1000 + ["alpha beta"]), "en"), (2, "gamma alpha", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.phrase: r.n_total for r in text_queries.postings_index(spark, str(tmp_path)).collect()}
    assert (got["one"], got["alpha"], got["gamma"]) == (1000, 2, 1)


def test_cooccurrences(docs, spark):
    lists = corpus.document_words(docs)
    counts = corpus.word_counts(corpus.each_sentence(lists))
    assert {r.word: r.cnt for r in counts.collect()} == {"the": 2, "cat": 3, "sat": 1, "on": 1, "mat": 1, "ran": 1, "a": 1, "and": 1, "dog": 1, "dogs": 1, "run": 1}
    got = {(r.word, r.cooc): r.score for r in corpus.cooccurrences(lists, counts, 0).collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "cat"} == {"the": 2000, "sat": 1407, "on": 1378, "ran": 1367, "mat": 1332, "a": 1000, "and": 1000, "dog": 902}
    assert {k[1]: v for k, v in got.items() if k[0] == "a"} == {"cat": 1000, "and": 950, "dog": 857}


def test_back_off(spark):
    probs = spark.createDataFrame([("new york", 0.001), ("york city", 0.0005), ("new", 0.01), ("york", 0.002), ("city", 0.003), ("hall", 0.001)], "phrase string, prob double")
    asked = ["new york", "new york city", "city hall", "new york city hall", "xyz", "xyz hall", ""]
    got = {r.phrase: r.prob for r in corpus.back_off(spark.createDataFrame([(a,) for a in asked], "phrase string"), probs).collect()}
    want = {"new york": 1e-3, "new york city": 2.0e-5, "city hall": 4.5e-5, "new york city hall": 5.586207e-7, "xyz": 1e-9, "xyz hall": 1e-9, "": 1e-9}
    assert got == {k: pytest.approx(v, rel=1e-5) for k, v in want.items()}


def test_association(spark):
    src = spark.createDataFrame([("a", 10), ("b", 100), ("c", 4)], "src string, cnt long")
    trg = spark.createDataFrame([("x", 8), ("y", 5), ("z", 12)], "trg string, cnt long")
    pair = spark.createDataFrame([("a", "x", 6), ("b", "y", 2), ("c", "z", 2)], "src string, trg string, cnt long")
    got = {(r.src, r.trg): round(r.score, 6) for r in corpus.association(src, trg, pair).collect()}
    assert got == {("a", "x"): 0.3, ("c", "z"): 0.047619}


def test_bleu(spark):
    candidate = lambda words: spark.createDataFrame([(1, "k", words)], "id long, key string, words array<string>")
    refs = spark.createDataFrame([("k", "the cat sat on the mat".split()), ("k", "a cat sat".split())], "key string, words array<string>")
    r = similarity.bleu(candidate("the cat sat on mat".split()), refs, 3).first()
    assert (round(r.bleu, 6), round(r.precision, 6)) == (0.649827, 0.805556)
    r = similarity.bleu(candidate(["the"] * 3), spark.createDataFrame([("k", ["the", "cat"])], "key string, words array<string>"), 2).first()
    assert (r.bleu, round(r.precision, 6)) == (0.0, 0.166667)


def test_twiddle(spark):
    lists = spark.createDataFrame([(1, "run", ["run", "runner", "walk", "ran", "sprinting run", "r"])], "qid long, q string, words array<string>")
    got = {r.word: (r.score, r.place) for r in similarity.twiddle(lists).collect()}
    assert [w for w, _ in sorted(got.items(), key=lambda x: x[1][1])] == ["run", "runner", "sprinting run", "ran", "walk", "r"]
    assert got["runner"][0] == pytest.approx(1.2727, abs=1e-4)


def test_cosine_and_softmax(spark):
    seeds = spark.createDataFrame([("s", "a", 1.0), ("s", "b", 0.5)], "seed string, label string, weight double")
    vectors = spark.createDataFrame([("c", "a", 0.8), ("c", "b", 0.1), ("c", "z", 3.0)], "id string, label string, weight double")
    assert similarity.seed_cosine(seeds, vectors).first().score == pytest.approx(0.942990, abs=1e-6)
    shares = vectors.select(similarity.softmax(F.col("weight"), "id").alias("s")).collect()
    assert sum(r.s for r in shares) == pytest.approx(1) and max(r.s for r in shares) == pytest.approx(math.exp(3) / (math.exp(0.8) + math.exp(0.1) + math.exp(3)))


def test_searches_equal_plain_ones(spark):
    words = sorted({a + b + c for a in ("ka", "ki", "re", "so", "") for b in ("n", "st", "r", "") for c in ("ol", "or", "i", "ä")})
    keys = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "key string, rank int")
    asked = ["kan", "kist", "o", "re", "ol", "kastor", "ä", "x"]
    queries = spark.createDataFrame(list(enumerate(asked)), "qid int, q string")

    def plain(test):
        return {(i, w) for i, q in enumerate(asked) for w in words if w and test(w, q)}

    def got(df):
        return {(r.qid, r.key) for r in df.collect()}

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    assert got(search.begins(queries, keys)) == plain(str.startswith)
    assert got(search.ends(queries, keys)) == plain(str.endswith)
    assert got(search.contains(queries, keys)) == plain(lambda w, q: q in w)
    assert got(search.edits(queries, keys)) == plain(lambda w, q: lev(w, q) <= 2)
    assert got(search.exact(queries, keys)) == plain(lambda w, q: w == q)


def test_example_gate_and_repeats(spark):
    good, target = "The big dog of the house ran over the hill today.", "犬が丘を越えて走ったのは昨日のことである。"
    rows = [(1, good, target), (2, "Short", target), (3, good, "」" + target), (4, good.replace("today", "now"), target)]
    pairs = spark.createDataFrame(rows, "id long, source string, target string").withColumn("g", F.lit(0))
    got = {r.id: r.reason for r in pairs.select("id", examples.reject_reason(F.col("source"), F.col("target")).alias("reason")).collect()}
    assert got == {1: None, 2: "source-short", 3: "target-bad-prefix", 4: None}
    assert {r.id for r in examples.near_repeats(pairs, "g", "id").where("repeats").collect()} == {3, 4}
    assert {r.id for r in examples.deduplicate(pairs, "id").collect()} == {1, 2, 4}


def test_assignment_respects_capacity(spark):
    scores = spark.createDataFrame([(f"k{i}", c, 1 / (1 + abs(i - 5 * c))) for i in range(10) for c in (0, 1)], "key string, cluster int, score double")
    got = {r.key: r.cluster for r in features.assign(scores, 5).collect()}
    assert len(got) == 10 and sorted(got.values()).count(0) == 5


def test_assignment_ends_when_none_is_refused(spark):
    n = 23
    scores = spark.createDataFrame([(f"k{i:02}", c, 1.0 - i / 1000 - c / 100) for i in range(n) for c in range(n)], "key string, cluster int, score double")
    assert {r.key: r.cluster for r in features.assign(scores, 1).collect()} == {f"k{i:02}": i for i in range(n)}


def test_items_without_scores_fill_free_places(spark):
    scores = spark.createDataFrame([("a", 0, 0.9), ("b", 0, 0.8), ("c", 0, 0.7)], "key string, cluster int, score double")
    items = spark.createDataFrame([(k,) for k in "abcdef"], "key string")
    clusters = spark.createDataFrame([(0,), (1,), (2,)], "cluster int")
    got = {r.key: r.cluster for r in features.assign(scores, 2, items, clusters).collect()}
    assert got == {"a": 0, "b": 0, "c": 1, "d": 1, "e": 2, "f": 2}
    assert {r.key: r.cluster for r in features.assign(scores, 2, items).collect()} == {"a": 0, "b": 0, "c": None, "d": None, "e": None, "f": None}


def test_every_root_is_classified(spark, tmp_path, monkeypatch):
    links = [(f"child{i}", f"root{i}") for i in range(330)]
    monkeypatch.setattr(text_queries, "edges", lambda s, d: spark.createDataFrame(links, "child string, parent string"))
    relation = [(k, "word", 0, k) for pair in links for k in pair] + [(c, "parent", 0, p) for c, p in links] + [(p, "child", 0, c) for c, p in links]
    monkeypatch.setattr(text_queries, "_relations", lambda s, d: spark.createDataFrame(relation, "key string, kind string, place int, label string"))
    monkeypatch.setattr(features, "cluster", lambda f, count, items: items.select("key", F.pmod(F.xxhash64("key"), F.lit(count)).cast("int").alias("cluster")))
    got = {r.key: r.cluster for r in text_queries.classify_words(spark, str(tmp_path)).collect()}
    assert set(got) == {p for _, p in links} and None not in got.values()
    assert max(list(got.values()).count(c) for c in got.values()) <= 15


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    sentences, lists = corpus.sentence_tokens(none, True), corpus.document_words(none)
    assert corpus.ngram_counts(sentences).count() == 0 and tuple(corpus.totals(sentences).first()) == (0, 0, 0)
    assert corpus.cooccurrences(lists, corpus.word_counts(sentences)).count() == 0
