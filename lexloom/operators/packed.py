"""Several values packed in one field: a parsing expression grammar that gives one row per member.

    text     <- section (mark section)*
    section  <- head list / other
    head     <- blank* ('[' name ']' / name 's'?) blank* ':'
    list     <- (divider / member)*
    member   <- quoted &end / bracketed / bare          (ordered; a quote that never closes before an end is backtracked over)
    quoted   <- '"' ('""' / '\\"' / !'"' .)* '"'  /  '“' .*? '”'  /  '「' .*? '」'  /  "'" .*? "'"  ...
    end      <- blank* (divider / end of section)
    divider  <- any character that can't stand in a bare member
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The list sections of a sense.
LIST_SECTIONS = ("translation", "synonym", "antonym", "hypernym", "hyponym")

_MARK = regex.compile(r"\[-{1,3}\]")
_LETTERS = r"\p{L}\p{M}\p{N}\p{Zs}\-‐‑'’."
_END = rf"(?=\p{{Zs}}*(?:[^{_LETTERS}()（）]|\Z))"
_BLANK = regex.compile(r"\s*")
_SPACES = regex.compile(r"\p{Zs}*")
_DIVIDER = regex.compile(rf"[^{_LETTERS}()（）]")
#: Ordered alternatives; the first that matches at a place is taken.
_QUOTED = (
    ('"', regex.compile(r'"((?:""|\\"|[^"])*)"' + _END)),
    ("“", regex.compile("“(.*?)”" + _END, regex.S)),
    ("「", regex.compile("「(.*?)」" + _END, regex.S)),
    ("『", regex.compile("『(.*?)』" + _END, regex.S)),
    ("‘", regex.compile("‘(.*?)’" + _END, regex.S)),
    ("'", regex.compile("'(.*?)'" + _END, regex.S)),
)
_OPENERS = {opener: rule for opener, rule in _QUOTED}
_BRACKETED = regex.compile(rf"[{_LETTERS}]*(?:[(（][{_LETTERS}]*[)）][{_LETTERS}]*)+(?![()（）])")
_BARE = regex.compile(rf"[{_LETTERS}()（）]+")
_UNESCAPE = regex.compile(r'""|\\"')


class Member(NamedTuple):
    val: str
    start: int
    kind: str
    error: str | None


def parse_list(text: str, at: int = 0, end: int | None = None) -> Iterator[Member]:
    """The members of the list text[at:end], with their place, kind ('quoted', 'bracketed', 'bare') and error.

    Errors: 'unclosed quote' where an opening quote was backtracked over and taken as a divider or apostrophe, 'unbalanced
    bracket' where round brackets don't pair. Empty members are passed over.
    """
    end = len(text) if end is None else end
    error = None
    while True:
        at = _BLANK.match(text, at, end).end()
        if at >= end:
            return
        opener = text[at]
        rule = _OPENERS.get(opener)
        m = rule.match(text, at, end) if rule else None
        if m:
            kind, val = "quoted", m.group(1)
            if opener == '"':
                val = _UNESCAPE.sub('"', val)
        else:
            if rule:
                error = "unclosed quote"
            if (m := _BRACKETED.match(text, at, end)) is not None and m.end() > at:
                kind, val = "bracketed", m.group()
            elif (m := _BARE.match(text, at, end)) is not None:
                kind, val = "bare", m.group()
                if any(b in val for b in "()（）"):
                    error = "unbalanced bracket"
            else:
                at += 1  # the divider itself
                continue
        if val.strip():
            yield Member(val.strip(), m.start(), kind, error)
        error = None
        at = m.end()
        # the divider that ends a member is spent: an opening quote right behind a bare member opens nothing
        rest = _SPACES.match(text, at, end).end()
        if rest < end and _DIVIDER.match(text, rest, end):
            at = rest + 1


def parse_sections(text: str, names: tuple[str, ...] = LIST_SECTIONS) -> Iterator[tuple[str, int, int, int]]:
    """(name, section number, start, end) of the list sections of a text."""
    head = _head(names)
    at, number = 0, 0
    while True:
        mark = _MARK.search(text, at)
        end = mark.start() if mark else len(text)
        number += 1
        if m := head.match(text, at, end):
            yield (m.group(1) or m.group(2)).lower(), number, m.end(), end
        if not mark:
            return
        at = mark.end()


_heads: dict[tuple[str, ...], regex.Pattern] = {}


def _head(names: tuple[str, ...]) -> regex.Pattern:
    if names not in _heads:
        any_name = "|".join(map(regex.escape, names))
        _heads[names] = regex.compile(rf"\s*(?:\[({any_name})\]|({any_name})s?)\s*[:：]", regex.I)
    return _heads[names]


def split_packed(df: DataFrame, id_col: str, text_col: str, names: tuple[str, ...] = LIST_SECTIONS) -> DataFrame:
    """One row per member of the list sections of a text, with its position.

    Result: the id, attr (section name, lower case, singular), value_no (from 1 over all sections of that attr in the text),
    val, section_no, start (offset in code points), kind and error. Rows without a list, null and empty texts give no row; the
    same row twice gives its members twice; other columns of `df` are ignored, whatever their names.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, attr string, value_no int, val string, section_no int, start int, kind string, error string"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], {k: [] for k in ("attr", "value_no", "val", "section_no", "start", "kind", "error")}
            for i, text in enumerate(batch.column(1).to_pylist()):
                counts: dict[str, int] = {}
                for attr, number, start, end in parse_sections(text, names):
                    for m in parse_list(text, start, end):
                        counts[attr] = counts.get(attr, 0) + 1
                        at.append(i)
                        for k, v in zip(out, (attr, counts[attr], m.val, number, m.start, m.kind, m.error)):
                            out[k].append(v)
            kinds = {"value_no": pa.int32(), "section_no": pa.int32(), "start": pa.int32()}
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, kinds.get(k, pa.string())) for k, v in out.items())], names=["id", *out])

    likely = "(?i)(" + "|".join(names) + r")s?\]?\s*[:：]"
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike(likely))
    return source.mapInArrow(parse, schema).withColumnRenamed("id", id_col)
