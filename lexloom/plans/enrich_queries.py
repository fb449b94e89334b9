"""Queries that enrich the lexicon, and the choice of translations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_word
from ..operators import corpus, enrich, lexicon
from ..operators.corpus import english, sentence_tokens, sentence_total, word_counts
from ..runtime import cut, table
from . import sqltext as q
from .corpus_queries import _PARALLEL, _phrase_pairs
from .lexicon_queries import _E, _EDGES, _INFL, _R, edges, lexicon_entries, rows


def valid_keys(spark, directory):
    """Keys that may head an entry."""
    return rows(spark, directory).select("key").distinct().where(enrich.is_valid_key(F.col("key")))


def _phrase_entries(spark, directory) -> DataFrame:
    """Words of the corpus and, as headwords of several words, its bigrams; those that begin with a vowel are taken for verbs."""
    s = cut(sentence_tokens(english(table(spark, directory, "documents").select("doc_id", "text", "lang")), True))
    n = sentence_total(s)
    words = word_counts(s).where("cnt >= 20").select(F.col("word").alias("key"), "cnt")
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.concat_ws(" ", F.get("words", i - 1), F.get("words", i)))
    grams = s.where(F.size("words") > 1).select(F.explode(F.array_distinct(pairs)).alias("key")).groupBy("key").agg(F.count("*").alias("cnt")).where("cnt >= 5")
    return cut(words.unionByName(grams).crossJoin(n).select("key", (F.col("cnt") / F.col("n_sentences")).alias("prob"), F.greatest(F.col("cnt") % 40, F.lit(1)).alias("n_items"), F.col("key").rlike("^[aeiou]").alias("moving")))


def idioms(spark, directory):
    """Idioms of the words of the corpus: bigrams by their first, last and rarest word."""
    return enrich.idioms(_phrase_entries(spark, directory))


def pivot_tokens(spark, directory):
    """The rarest word of each bigram."""
    return enrich.pivot_tokens(_phrase_entries(spark, directory))


def _told_relations(spark, directory):
    links = table(spark, directory, "word_links")
    kind = lambda c, name: links.select(normalize_word(F.col("word")).alias("key"), F.posexplode(c).alias("place", "rel"), F.lit(name).alias("kind"), F.lower(F.trim(F.coalesce("label", F.lit("")))).alias("label"))
    told = kind("parent", "hypernym").unionByName(kind("child", "synonym")).withColumn("rel", normalize_word(F.col("rel")))
    return told.where("key != '' and rel != ''")


def related_headwords(spark, directory):
    """Headwords that the links relate, with those links left out that make a family by key order."""
    e = lexicon_entries(spark, directory).select("key", "prob", "n_items")
    r = _told_relations(spark, directory)
    names = r.select(F.col("rel").alias("key")).unionByName(r.select("key")).distinct()
    entry = names.join(e, "key", "left").select("key", F.coalesce("prob", F.lit(1e-6)).alias("prob"), F.coalesce("n_items", F.lit(3)).alias("n_items"))
    family = edges(spark, directory).where("child < parent")
    return enrich.related(r, entry, family)


def acquisition_ages(spark, directory):
    """Ages of acquisition of headwords, their parents' as concepts' and their plurals' bases'."""
    e = lexicon_entries(spark, directory).select("key", "prob", (F.lit(0.2) + F.col("n_items") % 5 / 5.0).alias("share"))
    ages = e.where(F.char_length("key") % 2 == 0).select("key", (F.char_length("key") + 0.25).alias("aoa"))
    concepts = edges(spark, directory).select(F.col("child").alias("key"), F.col("parent").alias("concept"))
    bases = e.select("key", F.left("key", F.char_length("key") - 1).alias("base")).where("base != ''")
    return enrich.acquisition(e, ages, concepts, bases)


def phrasal_inflections(spark, directory):
    """Inflections of verbs of several words: verbs with a particle behind them."""
    verbs = rows(spark, directory).where("pos = 'verb'").select("key").distinct()
    phrasal = verbs.where(~F.contains("key", F.lit(" "))).select(F.concat("key", F.lit(" up")).alias("key"))
    forms = verbs.where(F.col("key").rlike("^[a-z]+$")).select("key", F.explode(lexicon.regular_inflections(F.col("key"), F.lit("verb"))).alias("i")).select("key", "i.form", "i.value")
    return enrich.phrasal_inflections(verbs.unionByName(phrasal), forms)


def _translations(rows_frame):
    return rows_frame.where("translation is not null").select("key", normalize_word(F.col("translation")).alias("translation")).where("translation != ''").distinct()


def minor_translations(spark, directory):
    """Translations of children that their parent doesn't have."""
    t = cut(_translations(rows(spark, directory)))
    minor = t.join(edges(spark, directory).select(F.col("child").alias("key"), F.col("parent").alias("main")), "key")
    told = _translations(rows(spark, directory).where("label = 'wn'"))
    return enrich.without_main_translations(minor, t, told)


def compensated_translations(spark, directory):
    """Translations of records that no sense has, for the first of their words that is a headword."""
    records = lexicon.sense_rows(table(spark, directory, "entry_records"))
    turned = _translations(records).groupBy("translation").agg(F.array_sort(F.collect_set("key")).alias("words"))
    return enrich.compensate_reverse(lexicon_entries(spark, directory), _translations(rows(spark, directory)), turned)


def _pair_table(spark, directory):
    src, trg, pair = corpus.pair_counts(_phrase_pairs(spark, directory))
    counted = pair.where("cnt >= 2").withColumnRenamed("cnt", "n")
    joined = counted.join(src, "src").join(trg.withColumnRenamed("cnt", "trg_cnt"), "trg")
    return joined.select("src", "trg", "n", "cnt", (F.col("n") / (F.col("cnt") + 2)).alias("ef"), (F.col("n") / (F.col("trg_cnt") + 2)).alias("fe"))


def top_targets(spark, directory):
    """The best target terms of each source phrase of the parallel lines."""
    return enrich.top_targets(_pair_table(spark, directory).select("src", "trg", F.col("n").alias("cnt")), 16)


def selected_targets(spark, directory):
    """The translations of source phrases worth keeping."""
    return enrich.select_targets(cut(_pair_table(spark, directory)), 3, 0.2, 0.3, 0.25)


def frequency_closeness(spark, directory):
    """How near the probability of headwords lies to that of common words."""
    return lexicon_entries(spark, directory).select("key", F.round(enrich.frequency_closeness(F.col("prob")), 9).alias("closeness"))


QUERIES = {
    f.__name__: f
    for f in (
        valid_keys, idioms, pivot_tokens, related_headwords, acquisition_ages, phrasal_inflections, minor_translations, compensated_translations, top_targets, selected_targets, frequency_closeness,
    )
}

_PARTICLES = (
    "aback about above abroad across after against ahead along amid among apart around as at away back before behind below beneath between beside beyond by despite during down except "
    "for forth from in inside into near of off on onto out outside over per re since than through throughout till to together toward under until up upon with within without via"
).split()
_HOLLOW = (
    "the a an I my me mine you your yours he his him she her hers it its they their them theirs we our us ours some any one someone something myself yourself yourselves himself herself "
    "itself themselves oneself who whom whose what where when why how and but not no never ever time place people person this these that those other another yes thou back much many more "
    "most good well better best all"
).split()


def _in(words: list[str]) -> str:
    return "(" + ", ".join(map(q.quote, words)) + ")"


_PHRASES = f"""{q.ENGLISH_WORDS},
bi as (select word as key, cnt from (select w[i] || ' ' || w[i + 1] as word, count(*) as cnt from (select distinct doc_id, sent_id, w[i:i + 1] as w, 1 as i from (select doc_id, sent_id, words as w, unnest(range(1, len(words))) as i from lowered)) group by all) where cnt >= 5),
pe as (select key, cnt / n_sentences as prob, greatest(cnt % 40, 1) as n_items, regexp_matches(key, '^[aeiou]') as moving from (select word as key, cnt from word_cnt where cnt >= 20 union all select key, cnt from bi), n),
ph as (select *, string_split(key, ' ') as w from pe where contains(key, ' ')),
pt as (select key, arg_min(token, (coalesce(p, 0), -i)) as rarest from (
  select x.key, x.i, x.token, pe.prob as p from (select key, w[i] as token, i from (select *, unnest([1, 2]) as i from ph where prob >= 1e-6)) x left join pe on pe.key = x.token
  where token not in {_in(_PARTICLES + _HOLLOW)} and regexp_full_match(token, '[-''\\p{{Latin}}]+')) group by all)"""
_BOUND = lambda n, k: f"trunc(least(greatest(log2({n}), 2), 6) * {k})"
_TELLS = f"""
told as (
  select {q.normalize_word('word')} as key, {q.normalize_word('p[i]')} as rel, 0.9 as kw, lower(trim(coalesce(label, ''))) as label, i - 1 as place from (select word, label, parent as p, unnest(range(1, len(parent) + 1)) as i from word_links)
  union all select {q.normalize_word('word')}, {q.normalize_word('p[i]')}, 1.0, lower(trim(coalesce(label, ''))), i - 1 from (select word, label, child as p, unnest(range(1, len(child) + 1)) as i from word_links)),
rl as (select * from told where key <> '' and rel <> '')"""
_T = f"t as (select distinct key, {q.normalize_word('translation')} as translation from r where translation is not null and {q.normalize_word('translation')} <> '')"
_LED = " or ".join(f"starts_with(trg, {q.quote(p + ' ')})" for p in "を に が へ や の と から で より な は です ます この その あの こと する される た て ある いる これ それ あれ れる という として だ など".split())
_TP = _in("を に が へ や の と から で より な は です ます この その あの こと する される た て ある いる これ それ あれ れる という として だ など".split())
_TABLE = f"{_PARALLEL}, pt as (select p.src, p.trg, p.cnt as n, s.cnt, p.cnt / (s.cnt + 2) as ef, p.cnt / (t.cnt + 2) as fe from pair_cnt p join src_cnt s using (src) join trg_cnt t using (trg) where p.cnt >= 2)"

SQL = {
    "valid_keys": f"with {_R} select distinct key from r where regexp_matches(key, '\\p{{Latin}}') and not regexp_matches(key, '^\\d+(st|nd|rd)?$')",
    "pivot_tokens": f"with {_PHRASES} select key, rarest from pt",
    "idioms": f"""
      with {_PHRASES},
      ways as (
        select key, prob, moving, w[1] as word, case when w[2] in {_in(_PARTICLES)} then 3.0 else 1.0 end as times from ph
        union all select key, prob, moving, w[2], 0.9 * (case when w[1] in {_in(_PARTICLES)} then 3.0 else 1.0 end) from ph
        union all select key, prob, moving, rarest, 0.8 * (case when w[1] in {_in(_PARTICLES)} or w[2] in {_in(_PARTICLES)} then 3.0 else 1.0 end) from ph join pt using (key)),
      b as (select x.word, x.key, h.n_items, max(round(x.prob / h.prob * x.times * (case when x.moving then 3 else 1 end), 9)) as score
        from ways x join pe h on h.key = x.word and h.prob >= 1e-6 and regexp_full_match(h.key, '[-\\p{{Latin}}]+') where x.prob / h.prob >= 0.001 group by all),
      o as (select *, row_number() over (partition by word order by score desc, key) as place from b)
      select word, place::int as place, key as idiom from o where place <= {_BOUND('n_items', 4)}""",
    "related_headwords": f"""
      with {_E}, {_EDGES}, {_TELLS},
      names as (select distinct key from (select rel as key from rl union all select key from rl)),
      en as (select n.key, coalesce(e.prob, 1e-6) as prob, coalesce(n_items, 3) as n_items from names n left join e using (key)),
      v as (select key, rel, sum(w) as votes from (select key, rel, label, max(round(kw * 30 / (least(place, 30) + 30), 9)) as w from rl where rel <> key group by all) group by all),
      fam as (select child as a, parent as b from edges where child < parent union select parent, child from edges where child < parent),
      s as (select v.key, v.rel, h.n_items, round(votes * (1 + 0.1 * exp(-abs(ln(0.001) - ln(greatest(o.prob, 1e-7))))) * (case when not {q.stop_word('v.rel')} then 1.0 when {q.stop_word('v.key')} then 0.3 else 0.1 end), 9) as score
        from v join en o on o.key = v.rel join en h on h.key = v.key where not exists (from fam where a = v.key and b = v.rel)),
      o as (select *, row_number() over (partition by key order by score desc, rel) as place from s)
      select key, place::int as place, rel as related from o where place <= {_BOUND('n_items', 6)}""",
    "acquisition_ages": f"""
      with {_E}, {_EDGES}, x as (select key, prob, 0.2 + n_items % 5 / 5.0 as share from e),
      a as (select key, len(key) + 0.25 as aoa, prob from x where len(key) % 2 = 0),
      c as (select x.key, min(a.aoa + least(greatest(ln(greatest(a.prob, 1e-9)) - ln(least(x.prob, 1e-7)), 0), 1)) as c from x join edges g on g.child = x.key join a on a.key = g.parent group by all),
      b as (select x.key, a.aoa + 1 as b from x join a on a.key = x.key[:-2]),
      j as (select x.key, case when share < 0.5 then (0.5 - share) * 4 else 0 end as bias, aoa, c, b from x left join a using (key) left join c using (key) left join b using (key))
      select key, round(aoa + bias, 3)::double as aoa, round(c + bias, 3)::double as aoa_concept, round(b + bias, 3)::double as aoa_base from j where coalesce(aoa, c, b) is not null""",
    "phrasal_inflections": f"""
      with {_R}, {_INFL}, v as (select distinct key from r where pos = 'verb'),
      p as (select key from v where contains(key, ' ') union all select key || ' up' from v where not contains(key, ' ')),
      t as (select key, w, w[i] as token, i from (select key, string_split(key, ' ') as w, unnest(range(1, len(string_split(key, ' ')) + 1)) as i from p)),
      h as (select t.*, token in {_in(_PARTICLES + _HOLLOW)} as hollow from t join v on v.key = token and not contains(v.key, ' ')),
      root as (select key, w, arg_min(token, (hollow, i)) as root from h where not hollow or i = 1 group by all),
      f as (select distinct key, third, present, past from wf where pos = 'verb'),
      u as (select key as root, unnest([third, present, past]) as value, unnest(['verb_singular', 'verb_present_participle', 'verb_past']) as form from f)
      select key, form, array_to_string(list_concat(w[1:list_position(w, root) - 1], [value], w[list_position(w, root) + 1:]), ' ') as value from root join u using (root)""",
    "minor_translations": f"""
      with {_R}, {_EDGES}, {_T},
      m as (select t.key, t.translation, parent as main from t join edges on child = t.key),
      own as (select distinct key, {q.normalize_word('translation')} as translation from r where label = 'wn' and translation is not null)
      select key, main, translation from m
      where exists (from own o where o.key = m.key and o.translation = m.translation and len(o.translation) >= 2)
        or not exists (from t o where o.key = m.main and (o.translation = m.translation or (len(o.translation) >= 2 and contains(m.translation, o.translation))))""",
    "compensated_translations": f"""
      with {_E}, {_T},
      rec as (select distinct {q.normalize_word('word')} as key, {q.normalize_word('translation')} as translation from entry_records where translation is not null and {q.normalize_word('word')} <> '' and {q.normalize_word('translation')} <> '')
      select min(key) as key, translation from rec where translation not in (select translation from t) and key in (select key from e) group by translation""",
    "top_targets": f"""
      with {_TABLE},
      s as (select src, trg, n as cnt, round(n * (case when regexp_matches(trg, '^[\\p{{Hiragana}}ー]+ [\\p{{Hiragana}}ー]+') or trg in {_TP} then 0.5 when {_LED} then 0.8 else 1 end)
        * (case when regexp_full_match(trg, '[ \\p{{Hiragana}}ー]+') then 0.5 else 1 end) * (case when len(trg) <= 1 then 0.5 when len(trg) <= 2 then 0.8 else 1 end), 9) as score from pt where not regexp_matches(trg, '[\\p{{S}}\\p{{P}}]'))
      select src, trg, cnt, (row_number() over (partition by src order by score desc, trg))::int as place from s qualify place <= 16""",
    "selected_targets": f"""
      with {_TABLE},
      x as (select *, regexp_matches(src, '^\\p{{Lu}}') as large, case when regexp_matches(src, '^\\p{{Lu}}') then lower(src) else upper(src[1]) || src[2:] end as other from pt where cnt >= 3 and len(src) > 1),
      tw as (select src as other, max(cnt) as oc from pt group by all),
      y as (select x.*, o.fe as ofe from x left join tw using (other) left join pt o on o.src = x.other and o.trg = x.trg where x.other = x.src or oc is null or x.cnt >= oc * (case when large then 5 else 1 end)),
      z as (select src, trg, large, least(ef, 1) as ef, least(case when other = src then fe else fe + coalesce(ofe, 0) end, 1) as fe from y),
      s as (select *, round(sqrt(ef * fe), 9) as score from z),
      k as (select *, exists (from s o where o.src = s.src and o.trg <> s.trg and starts_with(o.trg, s.trg) and o.score >= 0.2 and (o.trg[2:] not in ('の', 'する') or not regexp_full_match(s.trg, '\\p{{Han}}+'))) as pre from s),
      f as (select * from k where not (len(trg) <= 1 and pre)
        and (case when large then score >= 0.3 when regexp_full_match(trg, '\\p{{Hiragana}}+') then score >= 0.25 else score >= 0.2 end)
        and not contains(lower(src), lower(trg)) and not contains(lower(trg), lower(src)) and trg not in ('する', 'ます', 'より', 'から') and not regexp_matches(trg, '^[っを]|[っを]$')
        and not regexp_matches(trg, '^[\\p{{Hiragana}}ー\\p{{Latin}}]$|^\\p{{Hiragana}}+[\\p{{Han}}\\p{{Katakana}}\\p{{Latin}}]|[\\p{{Han}}\\p{{Katakana}}ー\\p{{Latin}}][はがをと]')),
      w as (select src, trg, round(score * (case when len(trg) <= 1 then 0.5 when len(trg) <= 2 then 0.9 else 1 end) * (case when regexp_full_match(trg, '[\\p{{Hiragana}}ー]+') or regexp_matches(trg, '\\d') then 0.8 else 1 end), 9) as v from f)
      select src, (row_number() over (partition by src order by v desc, trg))::int as place, regexp_replace(trg, '([\\p{{Han}}\\p{{Katakana}}ー\\p{{Latin}}])だ', '\\1な', 'g') as target from w qualify place <= 8""",
    "frequency_closeness": f"with {_E} select key, round(exp(-abs(ln(0.001) - ln(greatest(prob, 1e-7)))), 9) as closeness from e",
}
