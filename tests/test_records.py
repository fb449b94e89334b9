"""Packed fields, nested records and forests against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lexloom.functions.keys import linked_keys, word_key
from lexloom.operators.forest import hierarchy
from lexloom.operators.nested import SchemaGraph, analyse, flat_table, lexicon_nodes, read_json, shred
from lexloom.operators.packed import parse_list, split_packed


def members(text):
    return [m.val for m in parse_list(text)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a, b; c", ["a", "b", "c"]),
        ('"x, y" | z', ["x, y", "z"]),
        ('"say ""hi"""/b', ['say "hi"', "b"]),
        ('"say \\"hi\\""/b', ['say "hi"', "b"]),
        ("“p; q”、「r, s」", ["p; q", "r, s"]),
        ("'St. x、y', o'z", ["St. x、y", "o'z"]),
        ("a (of b), c-d", ["a (of b)", "c-d"]),
        ('"open, b', ["open", "b"]),
        ('a "b, c" d', ["a", "b", "c", "d"]),
        ('x\t"y"\tz', ["x", "y", "z"]),
        (",, ;", []),
        ("", []),
        ('""', []),
        ("'tis, b", ["'tis", "b"]),
    ],
)
def test_list_grammar(text, want):
    assert members(text) == want


def test_list_errors_are_flagged():
    assert [m.error for m in parse_list('"open, b')] == ["unclosed quote", None]
    assert [(m.kind, m.error) for m in parse_list("a (b, c)")] == [("bare", "unbalanced bracket"), ("bare", "unbalanced bracket")]


def test_split_packed(spark):
    text = "gloss [-] Synonyms: a, b [--] e.g.: c, d [-][synonym]:c[---] [Antonym]: x [-] [synset]: 1-n"
    rows = [(1, text, "t"), (2, None, "t"), (3, "", "t"), (4, "synonym", "t"), (1, text, "t")]
    df = spark.createDataFrame(rows, "id long, body string, attr string")
    got = split_packed(df, "id", "body").select("id", "attr", "value_no", "val").collect()
    one = [(1, "antonym", 1, "x"), (1, "synonym", 1, "a"), (1, "synonym", 2, "b"), (1, "synonym", 3, "c")]
    assert sorted(map(tuple, got)) == sorted(one * 2)
    assert split_packed(df.limit(0), "id", "body").count() == 0


def test_very_long_list(spark):
    text = "[synonym]: " + ", ".join(f"w{i}" for i in range(20000))
    df = spark.createDataFrame([(1, text)], "id long, body string")
    assert split_packed(df, "id", "body").agg(F.max("value_no")).first()[0] == 20000


def test_read_json():
    assert read_json("﻿ [1] ") == [1]
    assert read_json(json.dumps(json.dumps({"a": 1}))) == {"a": 1}
    assert read_json('[{"a":') is None and read_json("") is None and read_json(None) is None
    assert read_json("[" * 100000) is None


def test_schema_graph_tables():
    graph = SchemaGraph((("entry", "item", True, True), ("entry", "meta", False, True), ("meta", "phrase", True, True), ("entry", "phrase", True, True), ("phrase", "x", True, False), ("meta", "rev", False, False), ("item", "item", False, True)))
    assert graph.tables() == {"entry", "item", "phrase", "x"}


def test_shred_and_nodes(spark):
    body = [{"word": "w", "item": [None, {"text": "t", "sub": {"k": 1}}, {}], "phrase": {"w": "p", "x": ["", "a", None, "b"]}, "meta": {"phrase": [{"w": "old", "x": ["-"]}]}}, None, {"item": {"label": "l"}, "phrase": None}]
    rows = [(1, json.dumps(body), "z"), (2, None, "z"), (3, "", "z"), (4, json.dumps(body)[:-5], "z"), (5, json.dumps(json.dumps(body[0])), "z"), (6, '[{"item":{"text":"\\ud800"}}]', "z")]
    df = spark.createDataFrame(rows, "body_id long, body string, path string")
    first = {(1, "item", 2, 0, "t"), (1, "phrase", 1, 0, "p"), (1, "x", 1, 2, "a"), (1, "x", 1, 4, "b")}
    got = {tuple(r) for r in lexicon_nodes(df).collect()}
    assert {r[1:] for r in got if r[0] == 1} == first | {(3, "item", 1, 0, "")}
    assert {r[1:] for r in got if r[0] == 5} == first
    assert {r[0] for r in got} == {1, 5, 6}
    assert lexicon_nodes(df.limit(0)).count() == 0
    tables = shred(df, "body_id", "body")
    items = flat_table(tables, "body_id", "item", ["text", "sub.k"]).where("body_id = 1 and text = 't'").first()
    assert (items["sub.k"], items["pos"], items["parent_pos"], items["path"]) == ("1", [1, 2], [1], "entry/item")
    assert ("entry", "meta", False, True) in analyse(df, "body").edges


def brute(links):
    parent = {}
    names = set()
    for c, p in links:
        names.add(c)
        if p is not None:
            names.add(p)
            parent[c] = min(p, parent.get(c, p))
    chains = {}
    for n in names:
        chain, at = [n], parent.get(n)
        while at is not None and at not in chain:
            chain.append(at)
            at = parent.get(at)
        chains[n] = (chain, at)
    rings = {n for n, (chain, at) in chains.items() if at == n}
    out = set()
    for n, (chain, at) in chains.items():
        if at is not None:
            out.add((n, "cycle" if n in rings else "below", "", -1, "", -1))
        else:
            below = sum(n in c[0][1:] for c in chains.values())
            out.add((n, "tree", chain[-1], len(chain) - 1, ">".join(reversed(chain)), below))
    return out


@pytest.mark.parametrize(("nodes", "many"), [(1000, 8), (30, 100), (20, 2)])
def test_hierarchy(spark, nodes, many):
    rng = random.Random(5)
    links = [(f"n{i}", f"n{rng.randrange(max(0, i - 6), i)}" if i % 9 else None) for i in range(1, 150)]
    links += [("r1", "r2"), ("r2", "r3"), ("r3", "r1"), ("b1", "r1"), ("b2", "b1"), ("s", "s"), ("t", "s"), ("lone", None)]
    links += [(f"c{i}", f"c{i + 1}") for i in range(60)] + [(f"hot{i}", "hub") for i in range(60)]
    df = spark.createDataFrame(links + links[:5] + [(None, "n1")], "child string, parent string").withColumn("state", F.lit(1))
    got = {tuple(r) for r in hierarchy(df, fragment_nodes=nodes, many=many).collect()}
    assert got == brute(links)


def test_hierarchy_of_nothing(spark):
    assert hierarchy(spark.createDataFrame([], "child string, parent string")).count() == 0


def test_linked_keys(spark):
    rows = [("É a", ["P", " ", None], None), ("p", None, ["e  A", ""]), (None, ["q"], None), ("", None, ["z"])]
    got = {tuple(r) for r in linked_keys(spark.createDataFrame(rows, "word string, parent array<string>, child array<string>")).collect()}
    assert got == {("e a", None), ("e a", "p"), ("p", None), ("q", None), ("z", None)}


def test_word_key():
    assert word_key("  Ａb  Éガ・x ") == "ａb eガx"
    assert word_key("é") == "e" and word_key("ガ") == "ガ"
