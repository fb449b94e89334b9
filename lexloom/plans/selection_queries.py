"""Queries of what dictionaries, word lists and quizzes take from the lexicon."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import cut_width, is_stop_word, normalize_word
from ..operators import examples, lexicon, selection
from ..operators.corpus import english, sentence_tokens
from ..operators.tokenize import tokens
from ..runtime import cut, table
from . import sqltext as q
from .enrich_queries import SQL as ENRICH_SQL
from .enrich_queries import _T, _translations, top_targets
from .lexicon_queries import _E, _EDGES, _INFL, _KEYS, _R, _TRAN, edges, key_ranks, lexicon_entries, rows
from .text_queries import _EXNUM, _PAIRS, pairs


def _turned(spark, directory):
    """translation, key, tran_prob: each headword's translations with their share of its senses."""
    t = rows(spark, directory).where("translation is not null").select("key", normalize_word(F.col("translation")).alias("translation")).where("translation != ''")
    n = t.groupBy("key").agg(F.count("*").alias("all"))
    return cut(t.groupBy("key", "translation").agg(F.count("*").alias("n")).join(n, "key").select("translation", "key", (F.col("n") / F.col("all") / 10).alias("tran_prob")))


def kept_entries(spark, directory):
    """Entries of the turned dictionary, with those of translations that end as a verb besides, by the reason why they stay."""
    items = _turned(spark, directory)
    verbs = items.where("length(translation) % 3 = 0").select(F.concat("translation", F.lit("する")).alias("translation"), "key", (F.col("tran_prob") * 5).alias("tran_prob"))
    words = items.groupBy("translation").agg((F.count("*") / 1e6).alias("prob"))
    phrases = lexicon_entries(spark, directory).select("key", "prob")
    keywords = items.where("length(translation) = 4").select("translation")
    return selection.keep_entries(items.unionByName(verbs), words, phrases, keywords)


def target_lists(spark, directory):
    """The best headwords of each translation."""
    return selection.target_list(lexicon.inverted_entries(rows(spark, directory)))


def _labelled(spark, directory):
    e = rows(spark, directory).groupBy("key").agg(F.max("prob").alias("prob"), F.count("*").alias("n_items"), F.array_compact(F.collect_set("label")).alias("labels"))
    cores = edges(spark, directory).groupBy(F.col("child").alias("key")).agg(F.min("parent").alias("core"))
    return e.join(cores, "key", "left")


def good_words(spark, directory):
    """Headwords worth a place in a small dictionary."""
    words = table(spark, directory, "word_links").where("link_id % 3 = 0").select(normalize_word(F.col("word")).alias("key")).where("key != ''")
    return selection.good_words(_labelled(spark, directory), words, "wn").withColumn("score", F.round("score", 9))


def good_entries(spark, directory):
    """Headwords that go into a book."""
    e = _labelled(spark, directory)
    return e.where(selection.is_good_entry(F.col("key"), F.col("prob"), F.col("labels"), 1e-6, 1e-4)).select("key")


def cluster_surfaces(spark, directory):
    """Headwords that may be items of clusters."""
    return lexicon_entries(spark, directory).where(selection.is_surface(F.col("key"))).select("key")


def entry_poses(spark, directory):
    """Parts of speech of each headword's first run of items."""
    s = table(spark, directory, "senses").select(normalize_word(F.col("word")).alias("key"), F.col("sense_id").alias("at"), F.lower(F.trim("label")).alias("label"), F.lower(F.trim("pos")).alias("pos"))
    return selection.entry_poses(s.where("key != ''"))


def first_listed(spark, directory):
    """Children of ranked headwords, each in the first section of a hundred that lists it."""
    ranks = key_ranks(spark, directory).select(F.col("key").alias("parent"), F.floor((F.col("rank") - 1) / 100).alias("section"))
    listed = ranks.join(edges(spark, directory), "parent").select("section", "child", "parent")
    probs = lexicon_entries(spark, directory).select(F.col("key").alias("child"), "prob")
    rows_ = listed.join(probs, "child", "left").withColumn("prob", F.coalesce("prob", F.lit(1e-7)))
    return selection.first_of(rows_, "section", "child", 1e-7)


def first_annotations(spark, directory):
    """Senses that an annotated book would show: the first of their headword with that translation and gloss."""
    s = table(spark, directory, "senses").where("word is not null").select(F.col("sense_id").alias("id"), F.col("word").alias("phrase"), F.coalesce("translation", F.lit("")).alias("tran"), F.coalesce("text", F.lit("")).alias("gloss"))
    return selection.first_annotations(s)


def quiz_window(spark, directory):
    """Headwords about a quiz's starting rank."""
    ranks = key_ranks(spark, directory).select("key", "rank")
    return selection.rank_window(ranks, 240)


def vocabulary_ages(spark, directory):
    """Ages of customers' vocabulary, orders standing for answers."""
    o = table(spark, directory, "orders").where("o_custkey % 3 = 0").select(F.col("o_custkey").alias("who"), (F.col("o_orderkey") % 18 + 3).cast("double").alias("age"), (F.col("o_orderkey") % 5 < 3).alias("right"))
    return selection.vocabulary_age(o)


def _prons(spark, directory):
    r = table(spark, directory, "entry_records").where("pronunciation is not null and word is not null")
    score = F.coalesce("probability", F.lit(0.0)) * F.log2(F.lit(2.0)) * 0.5
    return r.select(normalize_word(F.col("word")).alias("word"), selection.plain_sound(F.col("pronunciation")).alias("sound"), score.alias("score")).where("word != '' and sound != ''")


def symbol_histogram(spark, directory):
    """Symbols of the pronunciations, with sample words by score."""
    return selection.symbol_samples(_prons(spark, directory))


def optional_homophones(spark, directory):
    """Words of one sound, whether optional parts are spoken or not."""
    p = _prons(spark, directory).select("word", F.regexp_replace("sound", "^ˈ?(.)", "($1)").alias("sound"))
    return selection.optional_homophones(p)


def chosen_readings(spark, directory):
    """The pronunciation most records give for a word."""
    r = table(spark, directory, "entry_records").where("pronunciation is not null")
    return selection.choose_readings(r.select(normalize_word(F.col("word")).alias("word"), F.col("record_id").alias("at"), F.col("pronunciation").alias("reading")).where("word != ''"))


def inflection_export(spark, directory):
    """Regular inflections of headwords with the headword's idf."""
    i = lexicon.inflection_index(rows(spark, directory)).join(lexicon_entries(spark, directory).select("key", "prob"), "key")
    return i.groupBy("key", "prob").agg(F.array_join(F.array_sort(F.collect_set("form")), ",").alias("forms")).select("key", "forms", selection.inflection_idf(F.col("prob")).alias("idf"))


def search_keys(spark, directory):
    """The forms under which a headword can be looked up."""
    return lexicon.inflection_index(rows(spark, directory)).select("key", "form").distinct()


def translation_sets(spark, directory):
    """The headwords of each translation as a set."""
    return _translations(rows(spark, directory)).groupBy("translation").agg(F.array_join(F.array_sort(F.collect_set("key")), "\t").alias("keys"))


def sense_votes(spark, directory):
    """Votes of the senses of a word, part of speech by part of speech."""
    s = rows(spark, directory).where("pos is not null").groupBy(F.col("key").alias("word"), F.col("pos").alias("synset")).agg((F.count("*") - 1).alias("score"))
    return selection.sense_votes(s).withColumn("score", F.round("score", 9))


def reverse_senses(spark, directory):
    """Headwords by a sense of exactly the translation asked for."""
    s = table(spark, directory, "senses").where("sense_id % 20 = 0 and translation is not null").select(F.col("sense_id").alias("qid"), F.lower("translation").alias("q"))
    senses = rows(spark, directory).where("translation is not null").select("key", F.col("prob").alias("score"), "translation", (F.col("prob") * 2).alias("translation_score"))
    return selection.reverse_senses(s, senses).withColumn("score", F.round("score", 9))


def shared_translations(spark, directory):
    """How many translations children share with their parents."""
    e = edges(spark, directory).select(F.col("child").alias("a"), F.col("parent").alias("b"))
    return selection.shared_translations(e, _translations(rows(spark, directory)))


def keyword_spans(spark, directory):
    """Phrases of four and five words that stand in several English sentences."""
    e = english(table(spark, directory, "documents").select("doc_id", "text", "lang"))
    s = cut(sentence_tokens(e, True)).select(F.concat_ws("-", "doc_id", "sent_id").alias("id"), "words")
    items = table(spark, directory, "eval_items").where("text is not null")
    words = F.split(F.lower(F.regexp_replace("text", r"[^\p{L}\p{N}]+", " ")), " ")
    keys = items.select(F.explode(F.when(F.size(words) >= 5, F.transform(F.sequence(F.lit(1), F.size(words) - 4), lambda i: F.array_join(F.slice(words, i, 5), " ")))).alias("key"))
    return selection.keyword_spans(s, keys, 5).groupBy("phrase").agg(F.count("*").alias("n"))


def posted_sentences(spark, directory):
    """Parallel lines posted under the first words of evaluation items."""
    p = pairs(spark, directory)
    words = F.filter(F.split(F.lower("source"), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    s = p.select(F.col("id").cast("string").alias("id"), words.alias("words"))
    probs = cut(s.select(F.explode(F.array_distinct("words")).alias("phrase")).groupBy("phrase").agg(F.count("*").cast("double").alias("prob")))
    posted = examples.postings(s, probs, longest=1)
    items = table(spark, directory, "eval_items").where("item_id % 20 = 0 and text is not null")
    first = F.lower(F.get(F.filter(F.split("text", r"[^\p{L}\p{N}_]+"), lambda w: F.char_length(w) >= 5), F.lit(0)))
    asked = items.select(F.col("item_id").alias("qid"), first.alias("q")).where("q is not null")
    return selection.posted_sentences(asked, posted, p.select(F.col("id").cast("string").alias("id"), "source"))


def tran_thesaurus(spark, directory):
    """Target terms that translate the same source phrases, the most telling first."""
    t = top_targets(spark, directory).select(F.col("src").alias("key"), F.col("trg").alias("translation"))
    return lexicon.thesaurus(cut(lexicon.co_translations(t)))


def inversion_ladder(spark, directory):
    """The dictionary turned round as far as translations are likely."""
    r = _turned(spark, directory)
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("tran_prob"), "translation")) - 1
    prob = lexicon_entries(spark, directory).select("key", "prob")
    told = _translations(rows(spark, directory).where("label = 'wn'"))
    found = selection.inversion_ladder(r.withColumn("place", place).join(prob, "key"), told)
    return found.select("translation", "key", F.round("score", 9).alias("score"))


def word_relations(spark, directory):
    """Forms, parents, children and synonyms of headwords; translations stand for synonyms."""
    s = table(spark, directory, "senses").where("translation is not null").select(normalize_word(F.col("word")).alias("key"), F.col("sense_id").alias("at"), normalize_word(F.col("translation")).alias("synonym"))
    return selection.word_relations(lexicon.inflection_index(rows(spark, directory)), edges(spark, directory), s.where("key != '' and synonym != ''"))


def synset_feedback(spark, directory):
    """Translations that senses give of their synsets."""
    r = table(spark, directory, "senses").where("text is not null").select("sense_id", normalize_word(F.col("word")).alias("key"), F.concat("text", F.lit(" [-] [synset]: "), F.col("sense_id").cast("string"), F.lit("-n [-] [translation]: "), F.coalesce("translation", F.lit("")), F.lit("(x), cat")).alias("text"))
    return selection.synset_feedback(r.where("key != ''")).select("key", "synset", F.array_join("translations", "|").alias("translations"))


def ja_stop_words(spark, directory):
    """Target terms of the parallel lines that carry no meaning of their own."""
    terms = pairs(spark, directory).select(F.explode(F.regexp_extract_all("target", F.lit(r"[\p{IsHan}]+|[\p{IsHiragana}]+|[\p{IsKatakana}ー]+|[A-Za-z0-9]+"), F.lit(0))).alias("term"))
    return terms.distinct().select("term", is_stop_word(F.col("term"), "ja").alias("stop"))


def cut_texts(spark, directory):
    """Glosses cut to a display width, and the translations of a headword that one line holds."""
    return table(spark, directory, "senses").where("text is not null").select("sense_id", cut_width(F.col("text"), 30).alias("text"))


def shown_items(spark, directory):
    """The glosses that an entry shows."""
    s = table(spark, directory, "senses").where("text is not null").select(normalize_word(F.col("word")).alias("key"), F.col("sense_id").alias("at"), (F.lower(F.trim("label")) == "wn").alias("main"), "text", tokens(F.col("text"), True).alias("words"))
    return selection.merge_items(s.where("key != '' and main is not null"), 4, 6, 12).select("key", "at", "aux")


QUERIES = {
    f.__name__: f
    for f in (
        kept_entries, target_lists, good_words, good_entries, cluster_surfaces, entry_poses, first_listed, first_annotations, quiz_window, vocabulary_ages, symbol_histogram, optional_homophones,
        chosen_readings, inflection_export, search_keys, translation_sets, sense_votes, reverse_senses, shared_translations, keyword_spans, posted_sentences, tran_thesaurus,
        inversion_ladder, word_relations, synset_feedback, ja_stop_words, cut_texts, shown_items,
    )
}

_LABELLED = f"""{_R}, {_EDGES},
lb as (select r.key, max(prob) as prob, count(*) as n_items, list(distinct label) filter (where label is not null) as labels from r group by all),
co as (select child as key, min(parent) as core from edges group by all),
le as (select lb.*, core from lb left join co using (key))"""
_SOUND = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(pronunciation, '^\\[([^\\]]+)\\]$', '\\1'), '\\[(.*?)\\]', '(\\1)', 'g'), '⟨(.*?)⟩', '\\1', 'g'), ':', 'ː', 'g'), '·', '', 'g')"
_PRONS = f"pr as (select * from (select {q.normalize_word('word')} as word, {_SOUND} as sound, coalesce(probability, 0) * 0.5 as score from entry_records where pronunciation is not null and word is not null) where word <> '' and sound <> '')"
_ITEM_WORD = r"lower(list_filter(regexp_split_to_array(text, '[^\p{L}\p{N}_]+'), lambda w: len(w) >= 5)[1])"

SQL = {
    "kept_entries": f"""
      with {_E}, t as (select key, {q.normalize_word('translation')} as translation from r where translation is not null and {q.normalize_word('translation')} <> ''),
      i0 as (select translation, key, count(*) / sum(count(*)) over (partition by key) / 10 as tran_prob from t group by key, translation),
      i as (select * from i0 union all select translation || 'する', key, tran_prob * 5 from i0 where len(translation) % 3 = 0),
      w as (select translation, count(*) / 1e6 as prob from i0 group by all),
      b as (select translation, max(tran_prob) as t, max(coalesce(e.prob, 0)) as p from i left join e using (key) group by all),
      told as (select b.translation, case when len(b.translation) = 4 and b.translation in (select translation from i0) then 'keyword' when t >= 0.2 then 'translation' when coalesce(w.prob, 0) >= 1e-5 then 'word'
        when coalesce(w.prob, 0) >= 1e-6 and t >= 0.02 then 'both' when p >= 1e-5 and t >= 0.02 then 'phrase' else 'dropped' end as reason from b left join w using (translation)),
      kept as (select distinct translation, lower(key) as key, regexp_extract(translation, '^(.{{2,}})(する|した|して|している|される|された|されて|されている)$', 1) as stem from i where translation in (select translation from told where reason <> 'dropped')),
      aff as (select translation from kept a where stem <> '' and stem in (select translation from kept) group by translation
        having bool_and(exists (from kept o where o.translation = a.stem and o.key = a.key)))
      select translation, case when translation in (select translation from aff) then 'affix' else reason end as reason from told""",
    "target_lists": f"""
      with {_TRAN}, s as (select translation, key, greatest(0.1, sqrt(max(own) over (partition by key))) + 0.5 * pow(0.8, row_number() over (partition by key order by own desc, translation) - 1) as score from t),
      o as (select *, row_number() over (partition by translation order by round(score, 12) desc, key) as place from s qualify place <= 8)
      select translation, place::int as place, key from o""",
    "good_words": f"""
      with {_LABELLED}, kw as (select distinct {q.normalize_word('word')} as key from word_links where link_id % 3 = 0 and {q.normalize_word('word')} <> '')
      select key, round(ln(prob + 1e-8) + 22 + coalesce(len(labels), 0) + ln(n_items) - (len(key) - len(replace(key, ' ', ''))), 9) as score from le
      where (key in (from kw) and prob > 1e-6) or core in (from kw) or (list_contains(labels, 'wn') and len(labels) >= 3 and prob > 0) or (not contains(key, ' ') and len(labels) >= 3 and prob >= 1e-5)""",
    "good_entries": f"""
      with {_LABELLED} select key from le where prob >= 1e-6 and (coalesce(list_contains(labels, 'wj'), false)
        or not ((regexp_matches(key, '(^| )[\\p{{Lu}}\\p{{P}}\\p{{S}}\\d]') and not coalesce(list_contains(labels, 'we'), false)) or (prob < 1e-4 and (contains(key, ' ') or coalesce(len(labels), 0) = 1))))""",
    "cluster_surfaces": f"with {_E} select key from e where regexp_full_match(key, '[a-z]+') and (len(key) > 2 or key in ('go', 'ax', 'ox', 'pi'))",
    "entry_poses": f"""
      with s as (select {q.normalize_word('word')} as key, sense_id as at_id, lower(trim(label)) as label, lower(trim(pos)) as pos from senses where {q.normalize_word('word')} <> ''),
      f as (select *, first_value(label) over (partition by key order by at_id) as f from s),
      l as (select *, sum((label is distinct from f)::int) over (partition by key order by at_id rows unbounded preceding) as gone from f),
      p as (select key, pos, min(at_id) as at_id from l where gone = 0 and pos is not null group by all)
      select key, string_agg(pos, ',' order by at_id) as poses from p group by all""",
    "first_listed": f"""
      with {_KEYS}, s as (select (rank - 1) // 100 as section, child, parent, coalesce(e.prob, 1e-7) as prob from k join edges on parent = k.key left join e on e.key = child)
      select section, child, parent, prob from s qualify row_number() over (partition by child order by section, parent) = 1""",
    "first_annotations": r"""
      with a as (select sense_id as id, lower(word) as p, regexp_replace(coalesce(translation, ''), '[^\p{Han}\p{Hiragana}\p{Katakana}]', '', 'g') as t,
        trim(lower(regexp_replace(coalesce(text, ''), '[^\p{Latin} ]', '', 'g'))[:20]) as g from senses where word is not null),
      b as (select * from a qualify row_number() over (partition by p, t order by id) = 1)
      select id from b qualify row_number() over (partition by p, g order by id) = 1""",
    "quiz_window": f"with {_KEYS} select key, rank from k where rank >= 120 and rank < 360",
    "vocabulary_ages": """
      with o as (select o_custkey as who, (o_orderkey % 18 + 3)::double as age, o_orderkey % 5 < 3 as good from orders where o_custkey % 3 = 0),
      a as (select who, coalesce(list(age order by age desc) filter (where good), []) as g, coalesce(list(age order by age) filter (where not good), []) as b from o group by all),
      s as (select who, len(g) as n, len(b) as m, case when len(g) > 0 then g[least(2, len(b) + 1, len(g) - 1) + 1] - greatest(3 - len(g), 0) else 0 end as best, b[least(1, len(b) - 1) + 1] - (case when len(b) >= 3 then 0.5 else 0 end) as worst from a)
      select who, least(greatest(round_even((case when m > 0 then (best * n + worst * m * 2) / (n + m * 2) else best end) + (case when m = 0 then 0.5 when m <= 1 then 0.25 else 0 end), 0), 3), 20)::int as age from s""",
    "symbol_histogram": f"""
      with {_PRONS}, s as (select word, sound, round(score, 12) as score, unnest(string_split(regexp_replace(sound, '\\(.*?\\)', '', 'g'), '')) as symbol from pr where word <> 'the'),
      c as (select symbol, count(*) as n from s where symbol <> '' group by all having count(*) >= 10),
      f as (select symbol, word, row_number() over (partition by symbol order by score desc, word, sound) as i from s qualify i <= 10)
      select symbol, n, words from c join (select symbol, string_agg(word, chr(9) order by i) as words from f group by all) using (symbol)""",
    "optional_homophones": f"""
      with {_PRONS}, p as (select word, regexp_replace(sound, '^ˈ?(.)', '(\\1)') as sound from pr),
      f as (select word, regexp_replace(sound, '\\((.*?)\\)', '\\1', 'g') as sound from p union all select word, regexp_replace(sound, '\\(.*?\\)', '', 'g') from p),
      d as (select distinct word, regexp_replace(sound, '[ˈˌ. ]', '', 'g') as sound from f)
      select sound, count(*) as n, string_agg(word, chr(9) order by word) as words from d where sound <> '' group by all having count(*) > 1""",
    "chosen_readings": f"""
      with s as (select {q.normalize_word('word')} as word, pronunciation as reading, count(*) as n, min(record_id) as first_id from entry_records where pronunciation is not null and {q.normalize_word('word')} <> '' group by all)
      select word, reading from s qualify row_number() over (partition by word order by n desc, first_id, reading) = 1""",
    "inflection_export": f"with {_E}, {_INFL} select key, string_agg(form, ',' order by form) as forms, case when prob > exp(-20) then printf('%.3f', -ln(prob)) else '20' end as idf from ii join e using (key) group by key, prob",
    "search_keys": f"with {_R}, {_INFL} select distinct key, form from ii",
    "translation_sets": f"with {_R}, {_T} select translation, string_agg(key, chr(9) order by key) as keys from t group by all",
    "sense_votes": f"""
      with {_R}, v as (select key as word, pos as synset, count(*) - 1 as score from r where pos is not null group by all),
      m as (select *, max(score) over (partition by word) as most, count(*) over (partition by word) as n from v)
      select word, synset, round(score / most * greatest(1, ln(n + 1)), 9) as score from m where most > 0 and score > 0""",
    "reverse_senses": f"""
      with {_R}, s as (select sense_id as qid, lower(translation) as q from senses where sense_id % 20 = 0 and translation is not null),
      m as (select qid, key, max(prob * 2) as score from s join r on lower(r.translation) = q group by all)
      select qid, key, round(score, 9) as score, (row_number() over (partition by qid order by round(score, 12) desc, key))::int as place from m""",
    "shared_translations": f"with {_R}, {_EDGES}, {_T} select child as a, parent as b, count(*) as n from edges join t x on x.key = child join t y on y.key = parent and y.translation = x.translation group by all",
    "keyword_spans": f"""
      with {q.ENGLISH_TOKENS}, w as (select string_split(lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') as w from eval_items where text is not null),
      k as (select distinct array_to_string(w[i:i + 4], ' ') as key from (select w, unnest(range(1, len(w) - 3)) as i from w)),
      g as (select distinct doc_id, sent_id, array_to_string(words[i:i + n - 1], ' ') as phrase from (select *, unnest(range(1, 6)) as n from lowered) cross join lateral (select unnest(range(1, len(words) - n + 2)) as i))
      select phrase, count(*) as n from g where phrase in (from k) group by all""",
    "posted_sentences": f"""
      with {_EXNUM}, u as (select distinct id, unnest(w) as phrase from pw), pc as (select phrase, count(*) as prob from u group by all),
      k as (select u.id, u.phrase from u join pc using (phrase) qualify row_number() over (partition by id order by prob, u.phrase) <= 50),
      s as (select id, phrase from k qualify row_number() over (partition by phrase order by md5('19780211|' || phrase || '|' || id), id::varchar) <= 100),
      qs as (select item_id as qid, {_ITEM_WORD} as q from eval_items where item_id % 20 = 0 and text is not null)
      select distinct qid, s.id::varchar as id, source from qs join s on phrase = q join pairs on pairs.id = s.id""",
    "tran_thesaurus": f"""
      with tt as ({ENRICH_SQL["top_targets"]}), t as (select distinct src as key, {q.normalize_word('trg')} as translation from tt),
      p as (select a.translation as a, b.translation as b, count(*) as n from t a join t b on a.key = b.key and a.translation <> b.translation group by all having count(*) >= 2),
      c as (select a, b, round(n + len(regexp_replace(b, '[^\\p{{Han}}]', '', 'g')) * 0.01 + len(regexp_replace(b, '[^\\p{{Katakana}}]', '', 'g')) * 0.001 + len(b) * 0.0001, 6) as c from p),
      o as (select *, row_number() over (partition by a order by c desc, b) as place from c)
      select a as translation, place::int as place, b as other from o x where not exists (from o y where y.a = x.a and y.place <= x.place and y.place > 3 and y.c < (y.place - 1) / 2 + 1)""",
    "inversion_ladder": f"""
      with {_E}, {_T.replace("distinct ", "")},
      i as (select translation, key, count(*) / sum(count(*)) over (partition by key) / 10 as tp from t group by key, translation),
      p as (select *, row_number() over (partition by key order by tp desc, translation) - 1 as place from i),
      wn as (select distinct key, {q.normalize_word('translation')} as translation from r where label = 'wn' and translation is not null),
      m as (select p.*, exists (from wn where wn.key = p.key and wn.translation = p.translation) as told from p where translation <> key),
      k as (select *, row_number() over (partition by key order by place) - 1 as rank from m
        where place = 0 or (place <= 1 and tp >= 0.01) or (place <= 2 and tp >= 0.02) or (place <= 3 and tp >= 0.04) or tp >= 0.1 or (told and place <= 1))
      select translation, k.key, round(greatest(0.1, sqrt(prob)) + 0.5 * pow(0.8::double, rank) + pow(tp, 0.75) + (case when told then 0.1 else 0 end), 9) as score from k join e on e.key = k.key""",
    "word_relations": f"""
      with {_R}, {_INFL}, {_EDGES},
      s as (select {q.normalize_word('word')} as key, sense_id, {q.normalize_word('translation')} as syn from senses where translation is not null and {q.normalize_word('word')} <> ''),
      sw as (select key, syn, round(pow(0.98::double, row_number() over (partition by key order by sense_id, syn) - 1), 9) as w from s where syn <> '' and syn <> key),
      v as (select key, syn, round(sum(w), 9) as w from sw group by all),
      a as (select key, string_agg(form, ',' order by form) as forms from (select distinct key, form from ii) group by all),
      b as (select child as key, string_agg(parent, ',' order by parent) as parents from edges group by all),
      c as (select parent as key, string_agg(child, ',' order by child) as children from edges group by all),
      d as (select key, string_agg(syn, ',' order by w desc, syn) as synonyms from v group by all)
      select key, coalesce(forms, '') as forms, coalesce(parents, '') as parents, coalesce(children, '') as children, coalesce(synonyms, '') as synonyms from a full join b using (key) full join c using (key) full join d using (key)""",
    "synset_feedback": f"""
      with r as (select {q.normalize_word('word')} as key, text || ' [-] [synset]: ' || sense_id || '-n [-] [translation]: ' || coalesce(translation, '') || '(x), cat' as text from senses where text is not null and {q.normalize_word('word')} <> ''),
      m as (select key, regexp_extract(text, '\\[synset\\]: ([-0-9a-z]+)', 1) as synset, list_filter(list_transform(string_split(regexp_replace(regexp_extract(text, '\\[translation\\]: ([^\\[]+)', 1), '\\([^)]+\\)', '', 'g'), ','), lambda x: {q.trim('x')}), lambda x: x <> '') as t from r)
      select key, synset, array_to_string(list_filter(t, lambda x, i: list_position(t, x) = i), '|') as translations from m where synset <> '' and len(t) > 0""",
    "ja_stop_words": f"""
      with {_PAIRS}, t as (select distinct unnest(regexp_extract_all(target, '[\\p{{Han}}]+|[\\p{{Hiragana}}]+|[\\p{{Katakana}}ー]+|[A-Za-z0-9]+')) as term from pairs)
      select term, regexp_matches(term, '[0-9]') or regexp_full_match(term, '[\\p{{Hiragana}}ー]+') or regexp_full_match(term, '[年月日]+') or regexp_matches(term, '\\p{{Latin}}') as stop from t""",
    "cut_texts": """
      with c as (select sense_id, i, text[i] as c, len(text) as n from (select sense_id, text, unnest(range(1, len(text) + 1)) as i from senses where text is not null)),
      w as (select *, coalesce(sum(case when unicode(c) > 256 then 2 else 1 end) over (partition by sense_id order by i rows between unbounded preceding and 1 preceding), 0) as used from c),
      k as (select sense_id, n, string_agg(c, '' order by i) as t, count(*) as m from w where used <= 30 group by all)
      select sense_id, case when m < n then t || '...' else t end as text from k union all select sense_id, '' from senses where text = ''""",
}
