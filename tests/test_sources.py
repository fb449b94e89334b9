"""Readers, writers and streams on small files."""

from lexloom.operators.corpus import ngram_counts, sentence_tokens, word_counts
from lexloom.sources import readers
from lexloom.streaming import counts


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_wiki_pages(spark, tmp_path):
    page = "<page><title>{}</title>{}<revision><model>wikitext</model><format>text/x-wiki</format><text>{}</text></revision></page>"
    (tmp_path / "d.xml").write_text("<mediawiki>" + page.format("A", "", "text") + page.format("B", '<redirect title="A"/>', "x") + page.format("C", "<restrictions>sysop</restrictions>", "x") + page.format("D", "", "") + "</mediawiki>")
    got = readers.wiki_pages(spark, str(tmp_path)).collect()
    assert [r.title for r in got if r.text == "text"] == ["A"]


def test_senses(spark):
    df = readers.senses(lines(spark, "word=Run\tnoun=a [-] b\tnoun=c\tverb=d", "noun=x", "word=y", "word=" + "z" * 50 + "\tnoun=n", ""))
    got = {(r.name, tuple(r["values"])) for r in readers.field_rows(df).collect()}
    assert got == {("noun", ("a [-] b", "c")), ("verb", ("d",))}
    assert readers.senses(lines(spark, "word=r\tnoun=a [-] b"), slim=True).first().fields[0].value == "a"


def test_tables_of_lines(spark):
    assert [tuple(r) for r in readers.listed_values(lines(spark, "A\tx\tX\ty", "b", "c\t ")).collect()] == [("a", ["x", "y"])]
    r = readers.parallel_corpus(lines(spark, "d\t0.5\ts\tt", "bad\tline")).collect()
    assert [tuple(x) for x in r] == [("d", 0.5, "s", "t")]
    ages = readers.acquisition_ages(lines(spark, "word,a,b,occur,mean,sd,x", "cat,0,0,9,3.0,1.0,0", "Cat,0,0,9,5.0,,0"))
    assert [tuple(x) for x in ages.collect()] == [("cat", 6.0)]


def test_synsets(spark):
    data = ["  1 comment", "00000001 03 n 02 big_dog 0 hound(p) 0 003 @i 00000002 n 0000 ;c 00000003 n 0000 #m 00000002 n 0000 | a dog ", "00000002 03 n 01 animal 0 000 | a being"]
    df = readers.synsets(lines(spark, *data))
    assert {(r.synset_id, tuple(r.words), r.gloss) for r in df.collect()} == {("00000001-n", ("big dog", "hound"), "a dog"), ("00000002-n", ("animal",), "a being")}
    assert {tuple(r) for r in readers.synset_relations(df).collect()} == {("big dog", "hypernym", "animal"), ("hound", "hypernym", "animal")}


def test_validation(spark):
    rows = [("a", '[{"word":"a","item":[{"label":"l","pos":"n","text":"t"}]}]'), ("b", '[{"word":"b","item":[]}]'), ("c", "junk"), ("d", '[{"word":"d","item":[{"label":"l","pos":"n"}]}]')]
    got = {r.key: r.problem for r in readers.valid_entries(spark.createDataFrame(rows, "key string, body string")).collect()}
    assert got == {"a": None, "b": "no item", "c": "no entry", "d": "no text"}


def test_key_table_and_lines(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "key string, n int")
    readers.write_table(df, str(tmp_path / "t"), "key")
    assert [r.key for r in readers.look_up(spark, str(tmp_path / "t"), "key", "b", "d").orderBy("key").collect()] == ["b", "c"]
    readers.write_lines(df, str(tmp_path / "l"), "key", "n")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "l")).collect()) == ["a\t1", "b\t", "c\t3"]
    assert readers.tokenised_documents(spark, str(tmp_path / "l")).count() == 3


def test_sample_is_stable(spark):
    ids = spark.range(10000)
    a = {r.id for r in readers.sample(ids, "id", 0.1).collect()}
    assert a == {r.id for r in readers.sample(ids.repartition(7), "id", 0.1).collect()} and 800 < len(a) < 1200


def test_streams_end_at_the_batch_counts(spark, tmp_path):
    rows = [(1, "The cat sat. The dog ran."), (2, "A cat."), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    for name, stream, batch in (("phrases", counts.phrase_counts, ngram_counts(sentence_tokens(df, False))), ("words", counts.word_counts, word_counts(sentence_tokens(df, True)))):
        query = stream(counts.document_stream(spark, str(tmp_path / "in"), df.schema, 1)).writeStream.outputMode("complete").format("memory").queryName(name).start()
        query.processAllAvailable()
        query.stop()
        assert {tuple(r) for r in spark.table(name).collect()} == {tuple(r) for r in batch.collect()}


def test_side_tables(spark):
    assert [tuple(r) for r in readers.hints(lines(spark, "Set\tnoun, verb\t0.5", "x\ty")).collect()] == [("set", "Set", ["noun", "verb"], 0.5)]
    assert [tuple(r) for r in readers.pronunciations(lines(spark, "Cat\tkæt", "Cat\tkat", "x")).collect()] == [("cat", "Cat", "kat")]
    assert {r.key for r in readers.keyword_list(lines(spark, "Cat ", "cat", "", "dog")).collect()} == {"cat", "dog"}
    fields = readers.senses(lines(spark, "word=Ｃａｔ\tsynonym=kitty\tnoun=a ﬁne pet\tsynonym=puss"))
    assert [tuple(r) for r in readers.related_fields(fields).collect()] == [("cat", "Cat", "synonym", "kitty, puss")]
