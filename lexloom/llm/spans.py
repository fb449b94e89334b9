"""Long spans that stand verbatim in more than one record: seed and extend.

Seeds are winnowed anchors: of every stretch of MIN_LENGTH characters at least one k-gram is chosen, by its content alone, so a
shared span has an anchor in both records. Most anchors stand in one record only: their hashes alone are counted first, the
repeated ones make a bitmap of bounded size, and only seeds that pass it are made with place and class. Occurrences of an anchor
are classed by the text around it, as far as a span of the least length that holds the anchor can reach. A class with two records
is shared as it stands. Of the others only one representative of each class is compared, and only with classes of its own anchor:
its text is extended both ways. Anchors with very many classes are decided exactly by the windows that hold them, dealt over all
tasks. What is found for a class holds for each of its occurrences; a record's shared characters are the union over its anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import BROADCAST_ROWS, clustered, cut

MIN_LENGTH = 200
ANCHOR = 80
#: Classes of an anchor up to which they are compared one by one; beyond, their windows are grouped.
PAIRED_CLASSES = 200
#: Characters worked on at once.
CHUNK = 1 << 17
#: Bits of a sieve: sixteen for each hash, up to this bound. A fuller sieve lets more pass that the exact joins leave out.
MOST_BITS = 1 << 27

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)
_LOW = _U((1 << 20) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    inverse = _U(pow(int(_MULTIPLIER), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.concatenate([[_U(1)], np.cumprod(np.full(n, _MULTIPLIER))])
        down = np.concatenate([[_U(1)], np.cumprod(np.full(n, inverse))])
    return up, down


_cached: tuple[np.ndarray, np.ndarray] = (np.empty(0, _U), np.empty(0, _U))


class Hashed:
    """Prefix hashes of a stretch of code points; `of` gives the hash of any part of it."""

    def __init__(self, points: np.ndarray) -> None:
        global _cached
        n = len(points)
        if len(_cached[0]) <= n:
            _cached = _powers(max(n, 2 * CHUNK))
        self.up, self.down = _cached
        with np.errstate(over="ignore"):
            self.prefix = np.concatenate([[_U(0)], np.cumsum(_mix((points.astype(_U) + _U(1)) * _MULTIPLIER) * self.up[:n])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((self.prefix[end] - self.prefix[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.prefix) - 1 - k + 1
        with np.errstate(over="ignore"):
            return _mix((self.prefix[k:] - self.prefix[:-k]) * self.down[:n])


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def winnow(points: np.ndarray, bounds: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of several texts laid end to end (bounds: their starts and the end): text number, place, anchor hash, class hash.

    Of each `least` characters of one text the k-gram with the least hash is an anchor, of equal ones the last.
    """
    n, width = len(points), least - k + 1
    none = np.empty(0, np.int64)
    if n < least:
        return none, none, none, none
    hashed = Hashed(points)
    grams = hashed.grams(k)
    low = (grams & ~_LOW) | (_LOW - (np.arange(len(grams), dtype=_U) & _LOW))
    span, reach = low, 1
    while reach < width:
        step = min(reach, width - reach)
        span = np.minimum(span[: len(span) - step], span[step:])
        reach += step
    starts, ends = bounds[:-1], bounds[1:]
    inside = np.zeros(n + 1, np.int32)  # windows that lie within one text
    long = ends - starts >= least
    inside[starts[long]] += 1
    inside[ends[long] - least + 1] -= 1
    chosen = span[np.cumsum(inside)[: len(span)] > 0]
    if len(chosen) > 1:
        chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]
    place = np.unique((_LOW - (chosen & _LOW)).astype(np.int64))
    number = np.searchsorted(starts, place, "right") - 1
    left = np.maximum(starts[number], place - (least - k))
    right = np.minimum(ends[number], place + least)
    with np.errstate(over="ignore"):
        sides = _mix(hashed.of(left, place) + (place - left).astype(_U)) * _U(3) + _mix(hashed.of(place + k, right) ^ (right - place).astype(_U))
        classes = _mix(sides)
    return number, place - starts[number], grams[place].view(np.int64), classes.view(np.int64)


def _groups(texts: list[str], chunk: int) -> Iterator[list[int]]:
    group, size = [], 0
    for i, text in enumerate(texts):
        if group and size + len(text) > chunk:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(text)
    if group:
        yield group


def _long_text(text: str, least: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text longer than a chunk, by overlapping stretches; each anchor has its whole surroundings in one of them."""
    points, margin = points_of(text), 2 * least
    places, anchors, classes = [], [], []
    for core in range(0, len(points), CHUNK):
        start, end = max(0, core - margin), min(len(points), core + CHUNK + margin)
        _, place, anchor, kind = winnow(points[start:end], np.array([0, end - start]), least, k)
        place = place + start
        own = (place >= core) & (place < core + CHUNK)
        places.append(place[own])
        anchors.append(anchor[own])
        classes.append(kind[own])
    return np.concatenate(places), np.concatenate(anchors), np.concatenate(classes)


class Sieve:
    """A bitmap of 64-bit hashes: what is in it passes, and little else does."""

    TRIES = 4

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @classmethod
    def of(cls, hashes: DataFrame, column: str, most_bits: int = MOST_BITS) -> Sieve:
        """From a materialised frame; only the bitmap comes to the driver, put together by the executors."""
        bits = min(most_bits, 1 << max(16, (16 * hashes.count()).bit_length()))
        low, high = F.col(column).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(column, 32)
        at = F.explode(F.array(*((low + high * n).bitwiseAND(F.lit(bits - 1)) for n in range(cls.TRIES)))).alias("at")
        put = hashes.select(at).groupBy(F.shiftright("at", 6).alias("word"))
        rows = put.agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask")).toPandas()
        words = np.zeros(bits >> 6, _U)
        words[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(_U)
        return cls(words)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        x = hashes.view(_U)
        low, high, last = x & _U(0xFFFFFFFF), x >> _U(32), _U((len(self.words) << 6) - 1)
        ok = np.ones(len(x), bool)
        for n in range(self.TRIES):
            at = (low + high * _U(n)) & last
            ok &= (self.words[at >> _U(6)] >> (at & _U(63)) & _U(1)).astype(bool)
        return ok


def _located(texts: list[str], least: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Text number, place, anchor hash and class hash of all anchors, some texts at a time."""
    for group in _groups(texts, CHUNK):
        if len(group) == 1 and len(texts[group[0]]) > CHUNK:
            place, anchor, kind = _long_text(texts[group[0]], least, k)
            number = np.zeros(len(place), np.int64)
        else:
            bounds = np.cumsum([0, *(len(texts[i]) for i in group)])
            number, place, anchor, kind = winnow(points_of("".join(texts[i] for i in group)), bounds, least, k)
        yield np.array(group, np.int64)[number], place, anchor, kind


def _hashes(least: int, k: int):
    """The distinct anchors of each text, without anything else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, anchor, _ in _located(batch.column(0).to_pylist(), least, k):
                order = np.lexsort((anchor, row))
                row, anchor = row[order], anchor[order]
                fresh = np.ones(len(row), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(anchor[fresh])], names=["anchor"])

    return run


def _seeds(least: int, k: int, sieve):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sieve.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.array([len(t) for t in texts], np.int64)
            for row, place, anchor, kind in _located(texts, least, k):
                keep = wanted.passes(anchor)
                row = row[keep]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(place[keep].astype(np.int32)), pa.array(sizes[row].astype(np.int32)), pa.array(anchor[keep]), pa.array(kind[keep])],
                    names=["doc", "pos", "n", "anchor", "class"],
                )

    return run


def _wanted_texts(sieve):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = sieve.value.passes(batch.column(2).to_numpy())
            yield batch.select(["doc", "text"]).filter(pa.array(keep))

    return run


def common_prefix(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def extend(members: list[tuple], least: int, k: int) -> Iterator[tuple[int, int, int]]:
    """(number of the member, characters to the left, to the right of its anchor's start) of each maximal match of a lone class.

    members: (first record, last record, text before the anchor, text from the anchor on). Matches shorter than `least` are left
    out, as are those that lie within another of the same member.
    """
    backward = [m[2][::-1] for m in members]
    for i, (first, last, _, after) in enumerate(members):
        if first != last:
            continue
        found = set()
        for j, (other, other_last, _, other_after) in enumerate(members):
            if i != j and (other != first or other_last != first):
                left, right = common_prefix(backward[i], backward[j]), common_prefix(after, other_after)
                if left + right >= least:
                    found.add((left, right))
        for left, right in found:
            if not any(a >= left and b >= right and (a, b) != (left, right) for a, b in found):
                yield i, left, right


def _extend_all(least: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def close() -> None:
            members = [row[2:] for row in held]
            out.extend((*held[i][:2], left, right) for i, left, right in extend(members, least, k))
            held.clear()

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[]] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["anchor", "class", "left", "right"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    close()
                held.append(row)
            yield flush()
        if held:
            close()
            yield flush()

    return run


def _surroundings(least: int, k: int):
    reach = least - k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for m in members:
                    p = m["pos"]
                    rows.append((m["anchor"], m["class"], m["first"], m["last"], text[max(0, p - reach) : p], text[p : p + least], m["classes"]))
            cols = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), batch.schema.field(1).type.value_type.field("first").type, batch.schema.field(1).type.value_type.field("last").type, pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["anchor", "class", "first", "last", "before", "after", "classes"])

    return run


def shared_spans(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH, anchor: int = ANCHOR, paired: int = PAIRED_CLASSES,
    held: int = BROADCAST_ROWS, most_bits: int = MOST_BITS,
) -> DataFrame:
    """For each document with a span of at least `least` characters that stands verbatim in another: the id, n_shared.

    n_shared counts the code points that lie in such spans, each once. Null, empty and shorter texts have none; copies of a
    text under another id share all of it; a span that only one document repeats is not shared. Ids must be unique. Other
    columns are ignored, whatever their names. A text of any length is worked through in overlapping stretches. Texts whose
    surroundings are compared are found by a broadcast of at most `held` places, beyond it by a sieve and a join.
    """
    spark, kind = documents.sparkSession, documents.schema[id_col].dataType.simpleString()
    source = documents.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")).where(F.char_length("text") >= least)
    repeated = cut(source.select("text").mapInArrow(_hashes(least, anchor), "anchor bigint").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    sieve = spark.sparkContext.broadcast(Sieve.of(repeated, "anchor", most_bits))
    seeds = cut(source.mapInArrow(_seeds(least, anchor, sieve), f"doc {kind}, pos int, n int, anchor bigint, class bigint"))

    classes = seeds.groupBy("anchor", "class").agg(F.min(F.struct("doc", "pos")).alias("at"), F.max("doc").alias("last"))
    classes = classes.select("anchor", "class", F.col("at.doc").alias("first"), F.col("at.pos").alias("pos"), "last", (F.col("at.doc") != F.col("last")).alias("shared"))
    by_anchor = (
        classes.groupBy("anchor")
        .agg(F.count("*").alias("classes"), F.min("first").alias("least_doc"), F.max("last").alias("most_doc"), F.min("shared").alias("all_shared"))
        .where("least_doc != most_doc")
        .select("anchor", "classes", "all_shared")
    )
    known = cut(classes.join(by_anchor, "anchor"))

    lone = known.where("classes > 1 and not all_shared")
    wanted = cut(lone.groupBy(F.col("first").alias("doc")).agg(F.collect_list(F.struct("anchor", "class", "pos", "first", "last", "classes")).alias("members")))
    if (wanted.agg(F.sum(F.size("members"))).first()[0] or 0) <= held:
        near = source.join(F.broadcast(wanted), "doc")
    else:
        docs = spark.sparkContext.broadcast(Sieve.of(wanted.select(F.xxhash64("doc").alias("hash")), "hash", most_bits))
        near = source.select("doc", "text", F.xxhash64("doc").alias("hash")).mapInArrow(_wanted_texts(docs), f"doc {kind}, text string").join(wanted, "doc")
    around = cut(near.select("text", "members").mapInArrow(
        _surroundings(least, anchor), f"anchor bigint, class bigint, first {kind}, last {kind}, before string, after string, classes bigint"
    ))
    few = around.where(F.col("classes") <= paired).select("anchor", "class", "first", "last", "before", "after")
    extended = clustered(few, "anchor").mapInArrow(_extend_all(least, anchor), "anchor bigint, class bigint, left int, right int")
    many = _by_windows(around.where(F.col("classes") > paired), least, anchor)

    whole = known.where("shared").select("anchor", "class", F.lit(least - anchor).alias("left"), F.lit(least).alias("right"))
    reach = whole.unionByName(extended).unionByName(many)
    found = seeds.join(reach, ["anchor", "class"]).select("doc", "n", F.greatest(F.col("pos") - F.col("left"), F.lit(0)).alias("a"), (F.col("pos") + F.col("right")).alias("b"))
    return _covered(found).withColumnRenamed("doc", id_col)


def _by_windows(around: DataFrame, least: int, k: int) -> DataFrame:
    """Of anchors with very many classes: the windows of `least` characters that hold the anchor, shared by two records."""
    offset = F.explode(F.sequence(F.lit(0), F.lit(least - k)))
    windows = (
        around.select("anchor", "class", "first", "last", "before", "after", offset.alias("left"))
        .where(F.char_length("before") >= F.col("left"))
        .where(F.char_length("after") >= F.lit(least) - F.col("left"))
        .withColumn("text", F.concat(F.expr("right(before, left)"), F.expr(f"left(after, {least} - left)")))
        .select("anchor", "class", "first", "last", "left", F.substring(F.sha2("text", 256), 1, 32).alias("digest"))
    )
    shared = windows.groupBy("digest").agg(F.min("first").alias("least_doc"), F.max("last").alias("most_doc")).where("least_doc != most_doc").select("digest")
    return windows.where("first = last").join(shared, "digest").select("anchor", "class", "left", (F.lit(least) - F.col("left")).cast("int").alias("right"))


def _covered(found: DataFrame) -> DataFrame:
    """Number of characters in the union of each document's stretches [a, b), cut at its end n."""
    merged = found.groupBy("doc", "a").agg(F.max(F.least("b", "n")).alias("b"))
    before = Window.partitionBy("doc").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    fresh = merged.withColumn("seen", F.coalesce(F.max("b").over(before), F.lit(0)))
    return fresh.groupBy("doc").agg(F.sum(F.greatest(F.col("b") - F.greatest("a", "seen"), F.lit(0))).cast("bigint").alias("n_shared"))
