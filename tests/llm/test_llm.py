"""The llm operators against plain Python, on small frames."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexloom.llm import charforms, consensus, leak, spans, tokens
from lexloom.llm.queries import QUERIES, survivors


@pytest.mark.parametrize(
    ("a", "b"),
    [("ｃａｔ", "cat"), ("ca​t", "cat"), ("cat ", "cat"), ("café", "café"), ("ｶﾞ", "ガ"), ("ガ", "ガ"), ("a‐b", "a-b"), ("ﬁn", "fin"), ("⽊", "木"), ("車", "車"), ("a  b", "a b"), ("ộ", "ộ"), ("か゛", "が"), ("x︀", "x")],
)
def test_fold(a, b):
    assert charforms.fold(a) == charforms.fold(b) == b


@pytest.mark.parametrize(("a", "b"), [("a", "A"), ("e", "é"), ("x²", "x2"), ("a,b", "a.b"), ("…", "..."), ("—", "-"), ("ſ", "s")])
def test_visible_differences_stay(a, b):
    assert charforms.skeleton(charforms.fold(a)) != charforms.skeleton(charforms.fold(b))


def test_resolve():
    assert charforms.resolve("kіtеn") == "kiten"
    assert charforms.resolve("жa") == "жа"  # a Latin a in a Cyrillic word
    assert charforms.resolve("夕メ工") == "タメエ" and charforms.resolve("へモ") == "ヘモ"
    assert charforms.resolve("あヘい") == "あへい"
    for word in ("cat", "ガメ", "日本", "кот", "κύκλος"):
        assert charforms.resolve(word) == word


def test_resolve_depends_on_the_look_alone():
    rng = random.Random(3)
    letters = "kaеoοрсtnжлαλ夕タ工エへヘ日あ"
    for _ in range(3000):
        token = "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
        assert charforms.resolve(token) == charforms.resolve(charforms.skeleton(token)), token
        assert charforms.skeleton(charforms.resolve(token)) == charforms.skeleton(token)


def test_same_look_and_unify(spark):
    rows = [(1, "cat", "x"), (2, "cаt", "x"), (3, "ｃat ", "x"), (4, "Cat", "x"), (5, None, "x"), (6, "", "x"), (7, " ", "x"), (8, "cat", "x"), (9, "dоg", "x"), (10, "dоg", "x"), (11, "dοg", "x")]
    df = spark.createDataFrame(rows, "id long, value string, look string")
    got = {tuple(r) for r in charforms.same_look(df, "id", ["value"]).collect()}
    want = {(1, 2), (1, 3), (2, 3), (2, 8), (3, 8), (6, 7), (9, 11), (10, 11)}
    assert got == {("value", a, b) for a, b in want}
    united = {r.row_key: r.unified for r in charforms.unify(df.withColumnRenamed("id", "row_key")).collect()}
    assert united[2] == united[3] == "cat" and united[5] is None and united[7] == "" and united[9] == united[11] == "dog"
    assert charforms.same_look(df.limit(0), "id", ["value"]).count() == 0
    alone = charforms.unify(spark.createDataFrame([(1, "dоg")], "row_key long, value string")).first().unified
    assert alone == "dоg"  # nothing in the corpus bears the repair out


def test_words():
    assert charforms.words("The ＣＡＴ's c​аt, x² ガ-ｶﾞ_1") == ["the", "cat", "s", "cat", "x", "ガ", "ガ", "1"]
    assert charforms.words("a\tb\nÉ") == ["a", "b", "é"] and charforms.words("") == []


def candidates(spark, rows):
    return spark.createDataFrame(rows, "group_id long, field string, value string, trust int, stamp string, id long")


@pytest.mark.parametrize("part", [400, 3])
def test_consensus_by_precedence(spark, part):
    rng = random.Random(2)
    rows = []
    for g in range(6):
        for i in range(12):
            value = " ".join(rng.choice("abcde") for _ in range(rng.randint(1, 5))) if i % 5 else None
            rows.append((g, "f", value, rng.randint(0, 2), rng.choice([None, "2021-01-01", "2022-01-01"]), g * 100 + i))
    want = {}
    for g, _, value, trust, stamp, i in rows:
        if value is not None:
            want[g] = max(want.get(g, (-1, "", -1)), (trust, stamp or "", i))
    got = {r.group_id: r.survivor for r in consensus.consensus(candidates(spark, rows), part_values=part).collect()}
    assert got == {g: w[2] for g, w in want.items()}


def test_consensus_by_votes(spark):
    rows = [(1, "f", "the big red dog", 5, None, 1), (1, "f", "the big dog", 4, None, 2), (1, "f", "the big dog", 4, None, 3), (1, "f", "the bag dog", 3, None, 4)]
    assert consensus.consensus(candidates(spark, rows), "sum").first().survivor == 3
    assert consensus.consensus(candidates(spark, rows)).first().survivor == 1
    assert consensus.consensus(candidates(spark, rows).limit(0)).count() == 0


def test_a_strict_order_aligns_nothing(spark):
    rows = [(1, "f", "a b", 1, None, 1), (1, "f", "c d", 1, "2021", 2), (1, "f", None, 9, "2022", 3)]
    plans = {how: consensus.consensus(candidates(spark, rows), how)._jdf.queryExecution().executedPlan().toString() for how in ("precedence", "sum")}
    assert "MapInArrow" not in plans["precedence"] and "MapInArrow" in plans["sum"]
    assert consensus.consensus(candidates(spark, rows)).first().survivor == 2


def test_alignment_and_votes_decide_consensus_records(spark, tmp_path):
    texts = [(1, "a x c d", "we"), (2, "a b y d", "wn"), (3, "z b c d", "wn"), (4, "a b c d", "wj")]
    rows = [(i, "cat", label, "noun", t, "kat" if i > 2 else None, None, "2021-01-01") for i, t, label in texts]
    spark.createDataFrame(rows, "record_id long, word string, label string, pos string, text string, pronunciation string, translation string, updated_at string").write.parquet(f"{tmp_path}/entry_records.parquet")
    spark.createDataFrame([("we", 5), ("wn", 4), ("wj", 1)], "label string, trust int").write.parquet(f"{tmp_path}/label_trust.parquet")
    got = {name: [tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()] for name in ("p3_found", "consensus_records")}
    assert got == {"p3_found": [(1, 1, 3, -1)], "consensus_records": [(1, 4, 3, -1)]}


@pytest.mark.parametrize("how", ["sum", "precedence"])
def test_consensus_is_the_same_at_every_size(spark, how):
    rng = random.Random(4)
    rows = [(g, "f", " ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 6))), rng.randint(0, 3), rng.choice([None, "2021"]), g * 1000 + i) for g in range(5) for i in range(60)]
    found = [{r.group_id: r.survivor for r in consensus.consensus(candidates(spark, rows), how, part).collect()} for part in (400, 2)]
    assert found[0] == found[1] and len(found[0]) == 5


def test_consensus_keeps_groups_whole_under_adaptive_joins(spark):
    rng = random.Random(5)
    rows = [(g, f, f"{rng.randint(0, 9)} x", rng.randint(0, 9), f"20{rng.randint(10, 20)}", g * 10 + i) for g in range(4000) for f in ("a", "b") for i in range(3)]
    want = {}
    for g, f, _, trust, stamp, i in rows:
        want[g, f] = max(want.get((g, f), (-1, "", -1)), (trust, stamp, i))
    got = {(r.group_id, r.field): r.survivor for r in consensus.consensus(candidates(spark, rows).repartition(4)).collect()}
    assert got == {k: v[2] for k, v in want.items()}


def test_survivors(spark):
    records = [
        (1, "Cat", " WN", "Noun", "old", "-", None, "2021-01-01"), (2, "cаt", "we", "noun ", "new", "kat", "…", "2022-01-01"), (3, "c·at", None, "noun", "", None, "猫", None),
        (4, "ca t", "wn", "noun", "x", None, None, None), (5, None, "wn", "noun", "x", None, None, None), (6, "cat", "wn", None, "x", None, None, None), (7, "càt", "wn", None, None, None, None, None),
    ]
    df = spark.createDataFrame(records, "record_id long, word string, label string, pos string, text string, pronunciation string, translation string, updated_at string")
    trust = spark.createDataFrame([("wn", 50), ("we", 50)], "label string, trust int")
    assert {tuple(r) for r in survivors(df, trust).collect()} == {(1, 2, 2, 3), (6, 6, -1, -1)}


def test_tokens(spark):
    texts = ["", None, "Hello world's 123 x² ½", "日本語の文 ガ", "😀 a\x85b\x1cc", "<|endoftext|> hi", "a  b\n\n c", "long " * 30000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("ids", F.lit("clash"))
    whole = tokens.load(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json")
    want = {i: whole.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    encoded = tokens.encode(df, "doc_id", "text")
    assert {r.doc_id: list(r.ids) for r in encoded.collect()} == want
    back = {r.doc_id: (r.text, r.complete) for r in tokens.decode(encoded, "doc_id").collect()}
    assert back == {i: (t or "", True) for i, t in enumerate(texts)}
    placed = tokens.encode(df.where("doc_id = 2"), "doc_id", "text", offsets=True).first()
    assert list(placed.ids) == want[2] and placed.starts[0] == 0 and placed.ends[-1] == len(texts[2])
    split = tokens.decode(spark.createDataFrame([(1, want[4][:1])], "doc_id int, ids array<int>"), "doc_id").first()
    assert not split.complete and "�" in split.text
    assert tokens.encode(df.limit(0), "doc_id", "text").count() == 0


def test_byte_table():
    table = tokens.byte_of_char()
    assert sorted(table.values()) == list(range(256)) and table["Ġ"] == 32 and table["A"] == 65


ITEM = "In 1990 the river of Bostok rose by 12 km and all people of the town left it for good"


def test_leaks(spark):
    tail = " ".join(ITEM.split()[3:16])
    docs = [(1, f"x {tail.upper()} y"), (2, " ".join(ITEM.split()[3:15])), (3, ITEM.replace("of", "of very")), (4, None), (5, ""), (6, ITEM.replace("1990", "1750").replace("12", "40")), (7, ITEM.replace(" ", " — ")), (7, ITEM), (8, "z " * 50000 + ITEM)]
    items = [(1, ITEM), (2, "short"), (3, None), (4, " "), (5, ITEM)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hash", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in leak.find_leaks(d, i).collect()}
    runs = lambda t: {tuple(w[k : k + 13]) for w in [charforms.words(t or "")] for k in range(len(w) - 12)}
    in_docs, in_items = [(a, runs(t)) for a, t in docs], [(b, runs(u)) for b, u in items]
    plain = {(a, b) for a, t in in_docs for b, u in in_items if t & u}
    assert got == plain and {(1, 1), (7, 5), (8, 1)} <= got and not {x for x in got if x[0] in (2, 3)}
    assert {tuple(r) for r in leak.find_leaks(d, i, block_windows=5).collect()} == plain
    changed = {tuple(r) for r in leak.find_leaks(d, i, exchanged=True).collect()}
    assert changed == {(6, 1), (6, 5)}
    assert leak.find_leaks(d.limit(0), i).count() == 0 and leak.find_leaks(d, i.limit(0)).count() == 0


def test_leaks_with_unseen_names_and_units(spark):
    item = "On a long road near the old mill Alice walked about 12 miles before the sun went down again"
    far = "we saw a red kite over seven green hills and then nobody spoke until it was gone from sight"
    docs = [(1, item.replace("Alice", "Zoltan")), (2, item.replace("miles", "km")), (3, item.replace("Alice", "Zoltan").replace("miles", "km").replace("12", "31")), (4, item), (5, item.replace("mill", "barn"))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(1, item), (2, far)], "item_id long, text string")
    for block in (1_000_000, 3):
        assert {tuple(r) for r in leak.find_leaks(d, i, window=13, exchanged=True, block_windows=block).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_words_of_verbatim_leaks_have_no_placeholder():
    codes = leak.codings(["1990", "1991", "km", "miles"], "1990 1991 km miles", False)[0]
    assert len(set(codes)) == 4 and min(codes) > leak.UNIT


def test_leak_kinds(spark, tmp_path):
    other = ITEM.replace("1990", "1750").replace("12", "40").replace("Bostok", "Zagreb")
    docs = [(1, f"x {ITEM} y"), (2, other), (3, f"{ITEM}. {other}"), (4, ITEM.replace("people", "birds").replace("river", "lake")), (5, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/eval_items.parquet")
    got = {name: sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()) for name in ("p7_found", "leak_kinds")}
    assert got["p7_found"] == [(1, 1), (3, 1)]
    assert got["leak_kinds"] == [(1, 1, "verbatim"), (2, 1, "exchanged"), (3, 1, "exchanged"), (3, 1, "verbatim")]


def test_recall_of_planted_exchanges(spark):
    rng = random.Random(8)
    plain = [f"{a}{b}{c}" for a in ("ro", "ta", "mi", "ne") for b in ("la", "ki", "su") for c in ("m", "r", "n", "st")]
    name = lambda: "".join(rng.choice(("Bal", "Dor", "Kel", "Mar", "Zan"))) + "".join(rng.choice("aeiou") + rng.choice("bdgklmnrst") for _ in range(2))

    def question():
        body = [rng.choice(plain) for _ in range(rng.randint(14, 22))]
        slots = rng.sample(range(1, len(body)), 4)
        return body, slots, rng.random() < 0.4  # whether a name begins it

    def fill(body, slots, led, values):
        out = list(body)
        for at, value in zip(slots, values):
            out[at] = value
        return (values[4] if led else out[0].capitalize()) + " " + " ".join(out[1:]) + "."

    values = lambda: [name(), name(), str(rng.randint(2, 999)), rng.choice(["km", "miles", "kg", "hours", "days"]), name()]
    asked, docs = [], []
    for i in range(60):
        form, one = question(), values()
        other = values()
        while set(one) & set(other) or len(set(one)) < 5 or len(set(other)) < 5:
            one, other = values(), values()
        asked.append((i, fill(*form, one)))
        docs.append((i, "It is said. " + fill(*form, other) + " So it went."))
    found = leak.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string"), exchanged=True)
    got = {tuple(r) for r in found.collect()}
    assert len([p for p in got if p[0] == p[1]]) >= 0.9 * len(asked) and all(a == b for a, b in got)


def test_hot_looks_pair_spellings_only(spark):
    rows = [(i, "cat") for i in range(400)] + [(1000 + i, "cаt") for i in range(3)]
    df = spark.createDataFrame(rows, "id long, value string")
    got = charforms.same_look(df, "id", ["value"])
    assert got.count() == got.distinct().count() == 1200 and got.where("id_a >= id_b").count() == 0


def shared(texts, least):
    where = {}
    for i, t in texts:
        for k in range(len(t or "") - least + 1):
            where.setdefault(t[k : k + least], set()).add(i)
    out = {}
    for i, t in texts:
        marks = set()
        for k in range(len(t or "") - least + 1):
            if len(where[t[k : k + least]]) > 1:
                marks.update(range(k, k + least))
        if marks:
            out[i] = len(marks)
    return out


@pytest.mark.parametrize(("paired", "held", "bits"), [(200, 1000, 1 << 20), (1, 1000, 1 << 20), (200, 0, 1 << 20), (200, 0, 64)])
def test_shared_spans(spark, paired, held, bits):
    rng = random.Random(7)
    fresh = lambda n: "".join(rng.choice("abcdeéガ日 ") for _ in range(n))
    passage, other = fresh(90), fresh(60)
    texts = [(i, fresh(rng.randint(0, 80)) + passage[rng.randint(0, 30) : rng.randint(60, 90)] + fresh(rng.randint(0, 60))) for i in range(12)]
    texts += [(20, fresh(30) + other + fresh(10) + other), (21, other), (22, "a" * 300), (23, "a" * 150), (24, None), (25, ""), (26, "😀" + passage), (27, "😀" + passage), (28, fresh(400)), (29, passage + passage)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("pos", F.lit("clash"))
    got = {r.doc_id: r.n_shared for r in spans.shared_spans(df, least=40, anchor=16, paired=paired, held=held, most_bits=bits).collect()}
    assert got == shared(texts, 40)
    assert spans.shared_spans(df.limit(0)).count() == 0


def test_long_texts_are_worked_in_stretches(spark, monkeypatch):
    rng = random.Random(9)
    base = "".join(chr(rng.randint(97, 122)) for _ in range(spans.CHUNK * 2 + 5000))
    piece = base[spans.CHUNK - 150 : spans.CHUNK + 150]
    df = spark.createDataFrame([(1, base), (2, "x" * 50 + piece)], "doc_id long, text string")
    assert {r.doc_id: r.n_shared for r in spans.shared_spans(df).collect()} == {1: 300, 2: 300}


def test_sieve(spark):
    rng = random.Random(1)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(3000)]
    sieve = spans.Sieve.of(spark.createDataFrame([(h,) for h in hashes[:1000]], "h long"), "h")
    passed = sieve.passes(spans.np.array(hashes, spans.np.int64))
    assert passed[:1000].all() and passed[1000:].mean() < 0.02


def test_winnowing_leaves_no_gap():
    rng = random.Random(4)
    text = "".join(rng.choice("abc") for _ in range(3000))
    _, place, _, _ = spans.winnow(spans.points_of(text), spans.np.array([0, len(text)]), 60, 20)
    assert all(any(s <= p <= s + 40 for p in place) for s in range(0, len(text) - 60 + 1))


def test_accents_survive():
    assert unicodedata.normalize("NFC", charforms.skeleton("ё")) == "ë"
