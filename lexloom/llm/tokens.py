"""Encoding of a corpus with a public tokenizer, and back."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files; a parameter of every function here.
TOKENIZER_DIR = "/opt/tokenizers"
#: Characters handed to the library at once, so that a batch of long texts stays small.
CHUNK_CHARS = 2_000_000

_loaded: dict[str, object] = {}


def byte_of_char() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte, reversed.

    The rule: printable bytes stand for themselves, all others are numbered from U+0100 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def load(path: str):
    """The tokenizer of a file, once per worker process; special strings in a text are ordinary text."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        tokenizer.no_padding()
        tokenizer.no_truncation()
        _loaded[path] = tokenizer
    return _loaded[path]


# Fixed value: the byte-level pre-tokeniser's pattern, with letters and digits as `re` can name them.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Number characters that are no decimal digits, separators that only one side counts as blanks, and all beyond the first plane:
#: texts with them are left to the library as a whole.
_UNLIKE = re.compile(
    "[\x1c-\x1f\x85\U00010000-\U0010ffff" + "".join(c for c in map(chr, range(0x10000)) if unicodedata.category(c) in ("No", "Nl")) + "]"
)
#: Distinct pieces remembered by a worker.
CACHE_PIECES = 300_000


class _PieceCache:
    """The ids of the pieces met so far, in one array, so that a batch is put together without a loop over tokens."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)

    def learn(self, pieces: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        length = np.fromiter(map(len, found), np.int64, len(found))
        start = len(self.ids) + np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64)
        for piece in pieces:
            self.code[piece] = len(self.code)
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in found for i in x), np.int32, int(length.sum()))])
        self.start, self.length = np.concatenate([self.start, start]), np.concatenate([self.length, length])

    def encode(self, texts: list[str]) -> pa.ListArray:
        if len(self.code) > CACHE_PIECES:
            self.clear()
        pieces: list[str] = []
        counts = []
        for text in texts:
            own = [text] if _UNLIKE.search(text) else _PIECE.findall(text)
            pieces += own
            counts.append(len(own))
        if fresh := list(set(pieces) - self.code.keys()):
            self.learn(fresh)
        codes = np.fromiter(map(self.code.__getitem__, pieces), np.int64, len(pieces))
        length = self.length[codes]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.start[codes] - (ends - length), length) + np.arange(total)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(self.ids[at], pa.int32()))


_caches: dict[str, _PieceCache] = {}


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    chunk, chars = [], 0
    for text in texts:
        if chunk and chars + len(text) > CHUNK_CHARS:
            yield chunk
            chunk, chars = [], 0
        chunk.append(text)
        chars += len(text)
    yield chunk


def encode(df: DataFrame, id_col: str, text_col: str, model: str = "byte_bpe_50k", offsets: bool = False, folder: str = TOKENIZER_DIR) -> DataFrame:
    """The ids of each text: the id column, ids array<int>, and with `offsets` starts and ends (array<int>, in code points).

    Texts are cut as the byte-level pre-tokeniser cuts them, the library encodes each distinct piece once, and the lists are put
    together in Arrow; models of another kind than byte-level BPE need `offsets`, which hands whole texts to the library. One row
    per input row; a null and an empty text give empty lists. No special tokens are added, whole texts are encoded. A
    character that several tokens share has the same start and end in each. Other columns are ignored, whatever their names.
    """
    path = f"{folder}/{model}.json"
    lists = pa.list_(pa.int32())

    def with_offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in batches:
            columns: list[list] = [[], [], []]
            for chunk in _chunks([t or "" for t in batch.column(1).to_pylist()]):
                for e in tokenizer.encode_batch(chunk, add_special_tokens=False):
                    columns[0].append(e.ids)
                    columns[1].append([a for a, _ in e.offsets])
                    columns[2].append([b for _, b in e.offsets])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, lists) for c in columns)], names=["id", "ids", "starts", "ends"])

    def ids_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _caches.setdefault(path, _PieceCache(load(path)))
        for batch in batches:
            parts = [cache.encode(chunk) for chunk in _chunks([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.concat_arrays(parts).cast(lists)], names=["id", "ids"])

    run = with_offsets if offsets else ids_only
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, ids array<int>" + ", starts array<int>, ends array<int>" * offsets
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(df: DataFrame, id_col: str, ids_col: str = "ids", model: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """The text of each list of ids: the id column, text, and complete (whether no character was split).

    Tokens are turned to bytes by the reversed byte table and the bytes to text as a whole, so characters split over tokens come
    out whole; bytes that are no UTF-8, as at the ends of a cut list, become U+FFFD. A null or empty list gives ''.
    """
    path = f"{folder}/{model}.json"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, table = load(path), byte_of_char()
        known: dict[int, bytes] = {}

        def piece(i: int) -> bytes:
            if i not in known:
                token = tokenizer.id_to_token(i) or ""
                known[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
            return known[i]

        for batch in batches:
            texts, complete = [], []
            for ids in batch.column(1).to_pylist():
                raw = b"".join(piece(i) for i in ids or ())
                try:
                    texts.append(raw.decode())
                    complete.append(True)
                except UnicodeDecodeError:
                    texts.append(raw.decode(errors="replace"))
                    complete.append(False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(complete)], names=["id", "text", "complete"])

    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(run, f"id {kind}, text string, complete boolean").withColumnRenamed("id", id_col)
