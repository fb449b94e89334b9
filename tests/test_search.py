"""The search layer on a small lexicon, against plain Python and values worked out by hand."""

import math
import re
import string

import pytest
from pyspark.sql import functions as F

from lexloom.operators import related, search

ENTRY = "key string, prob double, aoa double, has_tran boolean, n_items int, n_labels int, n_children int, inflections array<string>"
ENTRIES = {
    "dog": (1e-3, 4.0, True, 5, 3, 2, ["dogs"]), "dog house": (1e-6, None, True, 1, 1, 0, []), "run": (2e-3, None, True, 9, 3, 0, ["runs", "ran", "running"]), "do": (5e-3, None, False, 2, 2, 0, []),
    "not": (1e-2, 3.5, True, 1, 1, 0, []), "be": (1e-2, None, True, 3, 1, 0, ["is"]), "well": (1e-4, None, True, 1, 1, 0, []), "known": (1e-5, None, False, 1, 1, 0, []), "the": (5e-2, None, True, 1, 1, 0, []),
}
FORMS = {"dogs": "dog", "runs": "run", "ran": "run", "running": "run", "is": "be"}


def annotated(text):
    """The rules of annotation, one word after another."""
    spans = [(m.group(), m.group()[0] in string.ascii_letters + string.digits) for m in re.finditer(r"[A-Za-z\d][-_'’A-Za-z\d]*|[^A-Za-z\d]+", text)]
    out, at = {}, -1
    for i, (span, is_word) in enumerate(spans):
        if not is_word:
            continue
        at += 1
        head = at == 0 or re.search(r"[.!?;:\n]", spans[i - 1][0])
        tokens = []
        for j in range(i, len(spans), 2):
            if j > i and not re.match(r"\s", spans[j - 1][0]) or len(tokens) > 3:
                break
            tokens.append(spans[j][0])
            phrase = " ".join(tokens)
            low = phrase.lower()
            bases = lambda x: [x, *([FORMS[x]] if x in FORMS else [])]
            tried = [(low, 1.0), *((b, 0.7) for b in bases(low) if b.count(" ") == low.count(" "))]
            if len(tokens) == 1:
                if m := re.search(r"(?i)^(.+)['’](s|ve|d|ll|m|re|em)$", span):
                    tried += [(m[1].lower(), 0.7), *((b, 0.6) for b in bases(m[1].lower()))]
                    tried += [(w, 0.0001) for w in (search.CONTRACTED | {"s": ["be"] if m[1].lower() in ("it", "he", "she") else []})[m[2].lower()]]
                if m := re.search(r"(?i)([a-z]{2,})n['’]t$", span):
                    tried += [(search.DRAWN_TO_NOT.get(m[1].lower(), m[1].lower()), 0.7), ("not", 0.0001)]
                if m := re.search(r"(?i)([a-z]{2,}s)['’]$", span):
                    tried += [(b, 0.7) for b in bases(m[1].lower())]
                if span.find("-") > 0:
                    for part in span.split("-"):
                        if re.search("[A-Za-z]{3,}", part):
                            tried += [(part.lower(), 0.0002), *((b, 0.0001) for b in bases(part.lower()))]
            for key, score in tried:
                if key in ENTRIES:
                    prob, aoa, tran, items, labels, children, infl = ENTRIES[key]
                    same = any(phrase == t or head and phrase != "I" and phrase[0].lower() + phrase[1:] == t for t in [key, *infl])
                    age = min(max(aoa or -math.log(prob + 1e-8) + 3.5, 3), 20)
                    score *= min(0.05, max(prob**0.5, 1e-5)) * 20 * (25 - age) / 10 * (1 if tran else 0.5) * math.log2(items + 1) * (labels + 1) * math.log2(children + 4)
                    score *= (1 if same else 0.2) * (200 if tran else 10) ** key.count(" ")
                    out[at, span, len(tokens), key] = max(out.get((at, span, len(tokens), key), 0), score)
    return out


TEXTS = ["The dogs ran. Dog house, dog  house (dog\nhouse)", "It's well-known: he don't run; Running is the dogs' thing, it’ll WON'T", "", None, "犬 dog", "dog " * 300, "I Dog"]


def test_annotation(spark):
    entry = spark.createDataFrame([(k, *v) for k, v in ENTRIES.items()], ENTRY)
    forms = spark.createDataFrame(list(FORMS.items()), "form string, key string")
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = {(r.id, r["at"], r.span, r.n, r.key): r.score for r in search.annotate_text(texts, entry, forms).collect()}
    want = {(i, *k): s for i, t in enumerate(TEXTS) for k, s in annotated(t or "").items()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_set_phrases(spark):
    forms = lambda q: spark.range(1).select(search.set_phrase_forms(F.lit(q)).alias("f")).first().f
    assert forms("take my time off") == ["take my off", "take off", "take one's time off", "take someone off", "take something off"]
    assert forms("hurt himself") == ["hurt oneself", "hurt someone", "hurt something"]
    assert forms("tom's dog") == ["one's dog"] and forms("dog") == [] and forms("") == []
    assert forms("call the dog back") == ["call the back", "call back", "call someone back", "call something back"]


def test_dispatch_and_popup(spark):
    keys = spark.createDataFrame([("cat", 1), ("cats eye", 2), ("dog", 3), ("one's dog", 4), ("big cat", 5)], "key string, rank int")
    index = spark.createDataFrame([("猫", "cat", 0.9), ("犬", "dog", 0.5)], "translation string, key string, score double")
    translations = spark.createDataFrame([("cat", "猫"), ("dog", "犬")], "key string, translation string")
    asked = [(1, "cat,dog"), (2, "my dog"), (3, "big cat house"), (4, "dig"), (5, "猫"), (6, "zzzzzzzzz"), (7, ""), (8, "x" * 49)]
    found = search.dispatch(spark.createDataFrame(asked, "qid int, q string"), keys, index, translations).collect()
    assert {(r.qid, r.step, r.key, r.view) for r in found} == {(1, "exact", "cat", "simple"), (1, "exact", "dog", "simple"), (2, "set-phrase", "one's dog", "full"), (3, "partial", "big cat", "simple"), (3, "partial", "cat", "simple"), (4, "edit", "dog", "full"), (5, "reverse", "cat", "full")}
    lemmas = spark.createDataFrame([("dogs", "dog", 0.5)], "form string, key string, score double")
    shown = search.popup(spark.createDataFrame([(1, "dogs"), (2, "cat"), (3, "czt")], "qid int, q string"), keys, lemmas).collect()
    assert {(r.qid, r.key) for r in shown} == {(1, "dog"), (2, "cat"), (3, "cat")}
    assert {(r.qid, r.key) for r in search.matching(["^c", "og$"], keys).collect()} == {(0, "cat"), (0, "cats eye"), (1, "dog"), (1, "one's dog")}


def test_related(spark):
    links = [("a", "related", 0, "b"), ("b", "related", 0, "c"), ("a", "translation", 0, "t"), ("d", "translation", 0, "t"), ("e", "translation", 0, "u")]
    relations = spark.createDataFrame(links, "key string, kind string, place int, label string")
    poses = spark.createDataFrame([(k, "noun", 2) for k in "abcde"] + [("a", "verb", 1)], "key string, pos string, n int")
    features = related.entry_features(relations, poses)
    assert {(r.label, round(r.weight, 4)) for r in features.where("key = 'a'").collect()} == {("a", 1.0), ("b", 0.95), ("t", 0.9025), ("__noun", 1.0), ("__verb", 0.5)}
    asked = spark.createDataFrame([(1, "a"), (2, "zz")], "qid int, q string")
    found = related.expand(asked, features, relations.where("kind != 'translation'"), relations.where("kind = 'translation'"))
    got = {r.key: r.score for r in found.collect()}
    assert set(got) == {"a", "b", "c", "d"} and got["a"] == 1.0 and got["d"] > got["c"]
