"""Repeated passages by an enhanced suffix array and its interval tree.

A string of ``MIN_BYTES`` bytes is a repeat if it starts at another place too
(in the same or another document).  Not every suffix is sorted: of each such
string the leftmost least-hash ``GRAM``-byte gram is its anchor, a choice that
depends on the string alone, so equal strings meet at equal anchors.  Anchors
whose gram occurs at one place only are dropped (counted over all documents;
the rest go into a Bloom filter of a fixed size, whose errors only add work).

The occurrences of a gram form a small enhanced suffix array: sorted by what
follows the gram, with the common prefixes of neighbours.  A stack scan opens
and closes the common-prefix intervals.  Each interval keeps its members in
order of what stands before the gram; when intervals are joined, neighbours in
that order tell how far a repeat extends to the left, which gives the
left-diverse (maximal) repeats and, for every occurrence, its longest ones.
All members of an interval are compared this way, not neighbours of the suffix
array only.

Equal texts are handled once.  The copies of a text inside a task, and the
equal surroundings of a gram inside a text (periodic text), are one item with
several positions.  A gram beyond ``HOT`` items is not gathered: equal
surroundings are reduced map-side to one, and the strings of those are hashed
and counted by an aggregation.

``maximal_repeats`` returns the groups.  A maximal repeat is found once, at the
anchor of its first ``MIN_BYTES`` bytes, from which it goes at most ``MIN_BYTES -
GRAM`` bytes to the left; to the right all bytes are compared that may belong to
one.  Anchors with the same bytes before them everywhere begin none and are
dropped first, and what follows is cut in the same way at lengths of four times
each other.  The intervals of what follows are each split by the
intervals of what stands before.  Copies of a text count as places; a text's
start and end differ from all others.

Defined results: a NULL text is empty; texts below ``MIN_BYTES`` bytes keep all
bytes.  Rows that repeat a text (with or without the id) repeat each other's
strings, so a long one loses all bytes in every row.  An empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrowth.llm import bloom, wordhash
from panelgrowth.llm.common import only, written

MIN_BYTES = 400
GRAM = 80
#: Items of a gram that one task takes; beyond it strings are counted instead.
HOT = 2_000
#: Ranges of the bytes before a hot gram that are handled apart.
SLICES = 16
#: Bytes of text handled at once, and starting positions of a block.
CHUNK = 1 << 22
BLOCK = 1 << 19
_LOW = np.uint64((1 << 20) - 1)

CONTEXT = "gram long, t binary, positions binary, before binary, after binary"


def anchors(data: np.ndarray, offsets: np.ndarray, size: int = MIN_BYTES,
            gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, gram hash, least and most bytes that its strings have before
    it) of the anchors of all ``size``-byte strings of the texts."""
    extra = size - gram
    got: list[tuple] = []
    last = np.repeat(offsets[1:], np.diff(offsets)) - size if len(data) else np.zeros(0, np.int64)
    for b in range(0, max(len(data) - size + 1, 0), BLOCK):
        part = data[b:b + BLOCK + size]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(wordhash._CODES[part] * wordhash._powers(wordhash._BASE, len(part), "up"), out=sums[1:])
        m = len(part) - gram + 1
        if m <= extra:
            break
        h = wordhash.mix64((sums[gram:] - sums[:-gram]) * wordhash._powers(wordhash._INVERSE, m, "down"))
        # hash above, position below: ties go to the left
        comb = (h & ~_LOW) | np.arange(m, dtype=np.uint64)
        w = extra + 1
        padded = np.full(-(-m // w) * w, np.iinfo(np.uint64).max, np.uint64)
        padded[:m] = comb
        grid = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        n = min(m - extra, BLOCK)
        least = np.minimum(back[:n], ahead[extra:extra + n])
        s = np.flatnonzero(np.arange(b, b + n) <= last[b:b + n])  # strings inside one text
        if not len(s):
            continue
        at = (least[s] & _LOW).astype(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        end = np.concatenate((cut[1:], [len(s)])) - 1
        got.append((at[cut] + b, h[at[cut]], at[cut] - s[end], at[cut] - s[cut]))
    if not got:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    pos, key, lo, hi = (np.concatenate(x) for x in zip(*got))
    # an anchor at a block's edge comes twice
    first = np.concatenate(([True], pos[1:] != pos[:-1]))
    start = np.flatnonzero(first)
    return pos[first], key[first], np.minimum.reduceat(lo, start), np.maximum.reduceat(hi, start)


def _chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of about ``CHUNK`` bytes of whole texts."""
    data, offsets = wordhash.text_bytes(column)
    k, n = 0, len(offsets) - 1
    while k < n:
        e = max(k + 1, int(np.searchsorted(offsets, offsets[k] + CHUNK, "right")) - 1)
        yield k, data[offsets[k]:offsets[e]], offsets[k:e + 1] - offsets[k]
        k = e


def text_key(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()[:16]


def repeated_grams(texts: DataFrame, size: int, gram: int) -> DataFrame:
    """gram hashes that occur as anchors at two places or more.  A second column
    of ``texts`` is the number of a text's copies, which are places as well."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data, offsets in _chunks(batch.column(0)):
                pos, key, _, _ = anchors(data, offsets, size, gram)
                doc = np.searchsorted(offsets, pos, "right") - 1
                raw = data.tobytes()
                name = np.array([int.from_bytes(text_key(raw[a:b])[:8], "little") for a, b in
                                 zip(offsets[:-1].tolist(), offsets[1:].tolist())], np.uint64)
                place = wordhash.mix64(name[doc] + (pos - offsets[doc]).astype(np.uint64)) if len(pos) else key
                if batch.num_columns > 1:
                    more = batch.column(1).to_numpy()[k + doc] > 1
                    key, place = np.concatenate((key, key[more])), np.concatenate((place, ~place[more]))
                yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(place.view(np.int64))], names=["gram", "place"])

    places = texts.mapInArrow(find, "gram long, place long")
    return (places.groupBy("gram").agg(F.min("place").alias("a"), F.max("place").alias("b"))
            .where("a < b").select("gram"))


def contexts(texts: DataFrame, grams: np.ndarray, size: int, gram: int) -> DataFrame:
    """One row per text, repeated gram and surroundings: the positions of the
    gram, and the bytes before (reversed) and after it that its strings have."""
    shared = texts.sparkSession.sparkContext.broadcast(grams)
    extra = size - gram

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        seen: set[bytes] = set()  # texts this task has met
        for batch in batches:
            for _, data, offsets in _chunks(batch.column(0)):
                pos, key, lo, hi = anchors(data, offsets, size, gram)
                if len(pos):
                    on = bloom.bloom_hits(held, key)
                    pos, key, lo, hi = pos[on], key[on], lo[on], hi[on]
                doc = np.searchsorted(offsets, pos, "right") - 1
                raw = data.tobytes()
                own, now, name = {}, -1, b""
                for p, g, a, b, d in zip(pos.tolist(), key.view(np.int64).tolist(), lo.tolist(), hi.tolist(), doc.tolist()):
                    if d != now:
                        now, name = d, text_key(raw[int(offsets[d]):int(offsets[d + 1])])
                        fresh = name not in seen
                        seen.add(name)
                    if fresh:
                        own.setdefault((name, g, raw[p - b:p][::-1], raw[p + gram:p + gram + extra - a]), []).append(
                            p - int(offsets[d]))
                items = list(own.items())
                for k in range(0, len(items), 8192):
                    some = items[k:k + 8192]
                    yield pa.record_batch([
                        pa.array([x[0][1] for x in some], pa.int64()), pa.array([x[0][0] for x in some], pa.binary()),
                        pa.array([np.array(x[1], "<i4").tobytes() for x in some], pa.binary()),
                        pa.array([x[0][2] for x in some], pa.binary()), pa.array([x[0][3] for x in some], pa.binary())],
                        names=["gram", "t", "positions", "before", "after"])

    return texts.mapInArrow(cut, CONTEXT)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class IntervalTree:
    """Longest repeats around the occurrences of one gram.

    ``before`` and ``after`` are the distinct surroundings, ``many`` tells which
    of them stand at several places.  ``left`` and ``right`` get, per item, the
    longest extension to the left and to the right over all repeats (of
    ``need`` bytes besides the gram, at least) that it is part of; -1: none.
    ``groups`` gets the maximal repeats: (left, right, items).
    """

    def __init__(self, before: list[bytes], after: list[bytes], many: list[bool], need: int, groups: bool = False):
        self.before, self.need = before, need
        self.left, self.right = [-1] * len(before), [-1] * len(before)
        self.groups: list[tuple[int, int, list[int]]] | None = [] if groups else None
        for i, m in enumerate(many):
            if m:
                self.left[i], self.right[i] = len(before[i]), len(after[i])
                if groups:
                    self.groups.append((len(before[i]), len(after[i]), [i]))
        order = sorted(range(len(after)), key=after.__getitem__)
        stack: list[list] = []  # open intervals: [depth, members in order of what stands before, joined]
        for k, i in enumerate(order):
            depth = common_prefix(after[order[k - 1]], after[i]) if k else 0
            self._close(stack, depth)
            stack.append([len(after[i]), [(before[i], i)], False])
        self._close(stack, -1)

    def _close(self, stack: list[list], depth: int) -> None:
        """Closes the intervals deeper than ``depth``."""
        while stack and stack[-1][0] > depth:
            d, members, joined = stack.pop()
            if joined:
                self._emit(d, members)
            if stack and stack[-1][0] >= depth:
                stack[-1][1], stack[-1][2] = self._join(stack[-1][1], members, stack[-1][0]), True
            elif depth >= 0:
                stack.append([depth, members, False])

    def _join(self, a: list, b: list, depth: int) -> list:
        """The members of two intervals; each smaller one is set beside its
        neighbours among the larger."""
        if len(a) < len(b):
            a, b = b, a
        for x in b:
            k = bisect_left(a, x)
            a.insert(k, x)
            for n in (k - 1, k + 1):
                if 0 <= n < len(a):
                    self._pair(x[1], a[n][1], depth)
        return a

    def _pair(self, i: int, j: int, depth: int) -> None:
        common = common_prefix(self.before[i], self.before[j])
        if common + depth >= self.need:
            for x in (i, j):
                self.left[x] = max(self.left[x], common)
                self.right[x] = max(self.right[x], depth)

    def _emit(self, depth: int, members: list) -> None:
        """The left-diverse repeats of a closed interval: runs of members whose
        common left side makes the repeat long enough."""
        if self.groups is None:
            return
        run, common = [members[0][1]], None
        for (x, i), (y, j) in zip(members, members[1:]):
            c = common_prefix(x, y)
            if c + depth >= self.need:
                run.append(j)
                common = c if common is None else min(c, common)
            else:
                if common is not None:
                    self.groups.append((common, depth, run))
                run, common = [j], None
        if common is not None:
            self.groups.append((common, depth, run))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """(gram, its rows) of rows sorted by gram."""
    now, rows = None, []
    for batch in (b.slice(k, 256) for b in batches for k in range(0, b.num_rows, 256)):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != now:
                if rows:
                    yield now, rows
                now, rows = row[0], []
            rows.append(row)
    if rows:
        yield now, rows


def _items(rows: list) -> tuple[list, list, list]:
    """before, after and the places (text, position) of the distinct surroundings."""
    places: dict[tuple, set] = {}
    for _, t, positions, before, after in rows:
        places.setdefault((before, after), set()).update(
            (t, p) for p in np.frombuffer(positions, "<i4").tolist())
    return [k[0] for k in places], [k[1] for k in places], [sorted(v) for v in places.values()]


def spans_by_tree(found: DataFrame, size: int, gram: int) -> DataFrame:
    """t, start, end: the repeats' bytes around each occurrence, by interval trees."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, rows in _groups(batches):
            if len(rows) == 1 and len(rows[0][2]) == 4:
                continue
            before, after, places = _items(rows)
            tree = IntervalTree(before, after, [len(p) > 1 for p in places], size - gram)
            for a, b, own in zip(tree.left, tree.right, places):
                if a < 0:
                    continue
                text, start, end = None, 0, 0
                for t, p in own:  # overlapping places of a text become one span
                    if t == text and p - a <= end:
                        end = p + gram + b
                        continue
                    if text is not None:
                        out.append((text, start, end))
                    text, start, end = t, p - a, p + gram + b
                out.append((text, start, end))
            if len(out) >= 8192:
                yield _span_batch(out)
                out = []
        if out:
            yield _span_batch(out)

    return (found.repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(scan, "t binary, start long, end long"))


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64()))],
                           names=["t", "start", "end"])


def spans_by_count(found: DataFrame, size: int, gram: int) -> DataFrame:
    """The same for grams with very many occurrences: each string of an
    occurrence is hashed and counted, and no occurrence meets the others."""
    extra = size - gram

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(t, p - len(before), p + gram + len(after))
                   for t, positions, before, after in zip(*(c.to_pylist() for c in batch.columns))
                   for p in np.frombuffer(positions, "<i4").tolist()]
            if out:
                yield _span_batch(out)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for g, t, positions, before, after in zip(*(c.to_pylist() for c in batch.columns)):
                head = g.to_bytes(8, "little", signed=True)
                for n in range(extra - len(after), len(before) + 1):  # bytes before the gram
                    name = hashlib.blake2b(head + before[:n] + b"|" + after[:extra - n] + bytes([n & 255, n >> 8]),
                                           digest_size=16).digest()
                    for p in np.frombuffer(positions, "<i4").tolist():
                        out.append((name, t, p - n))
                if len(out) >= 8192:
                    yield _string_batch(out)
                    out = []
            if out:
                yield _string_batch(out)

    found = found.withColumn("same", F.xxhash64("gram", "before", "after"))
    one = F.octet_length("positions") == 4
    equal = found.groupBy("same").agg(
        F.count(F.lit(1)).alias("n"), F.max((~one).cast("int")).alias("several"), F.min(F.xxhash64("t")).alias("first"))
    named = written(found.join(equal, "same"), "repeats-equal")
    # surroundings that stand at several places are repeats as a whole
    whole = named.where("n > 1 OR several = 1").select("t", "positions", "before", "after").mapInArrow(
        spread, "t binary, start long, end long")
    # of all others, and one of each of these, the strings are counted
    rows = written(named.where(F.xxhash64("t") == F.col("first")).select(
        "gram", "t", "positions", "before", "after").mapInArrow(strings, "name binary, t binary, start long"),
        "repeats-strings")
    place = F.xxhash64("t", "start")
    twice = rows.groupBy("name").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b").select("name")
    counted = rows.join(twice, "name").select("t", "start", (F.col("start") + size).alias("end")).distinct()
    return whole.unionByName(counted)


def _string_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.binary(), pa.int64()))],
                           names=["name", "t", "start"])


def found_contexts(texts: DataFrame, size: int, gram: int, bloom_bits: int) -> DataFrame:
    grams = written(repeated_grams(texts, size, gram), "repeats-grams")
    return written(contexts(texts, bloom.bloom_filter(grams, bloom_bits), size, gram), "repeats-contexts")


def repeat_spans(texts: DataFrame, size: int = MIN_BYTES, gram: int = GRAM, hot: int = HOT,
                 bloom_bits: int = bloom.BITS) -> DataFrame:
    """t (16 bytes of the text's SHA-256), start, end: byte spans covered by
    repeats of ``size`` bytes between different texts or inside one.  ``texts``
    has one column."""
    found = found_contexts(texts, size, gram, bloom_bits)
    many = written(found.groupBy("gram").count().where(F.col("count") > hot).select("gram"), "repeats-hot")
    if many.isEmpty():
        return spans_by_tree(found, size, gram)
    return spans_by_tree(found.join(many, "gram", "left_anti"), size, gram).unionByName(
        spans_by_count(found.join(many, "gram", "left_semi"), size, gram))


def _reach(batch: pa.RecordBatch, held: np.ndarray, size: int, gram: int) -> Iterator[tuple]:
    """(bytes, row, text's start and end, position, gram, low, high, end of the
    covered span and one byte more) of the anchors of the given grams inside
    repeats.  The columns are text, n and spans."""
    for k, data, offsets in _chunks(batch.column(0)):
        pos, key, lo, hi = anchors(data, offsets, size, gram)
        on = bloom.bloom_hits(held, key) if len(pos) else np.zeros(0, bool)
        pos, key, lo, hi = pos[on], key[on], lo[on], hi[on]
        doc = np.searchsorted(offsets, pos, "right") - 1
        raw, now = data.tobytes(), -1
        for p, g, a, b, d in zip(pos.tolist(), key.view(np.int64).tolist(), lo.tolist(), hi.tolist(), doc.tolist()):
            if d != now:
                now, begin, end = d, int(offsets[d]), int(offsets[d + 1])
                spans = merge_spans([(x["start"], x["end"]) for x in batch.column(2)[k + d].as_py()])
                starts = [x[0] for x in spans]
            near = bisect_left(starts, p - begin + 1) - 1
            if near >= 0 and spans[near][1] >= p - begin + gram:
                yield raw, k + d, begin, end, p, g, a, b, min(begin + spans[near][1] + 1, end)


def _levels(raw: bytes, p: int, g: int, stop: int, size: int, gram: int) -> Iterator[tuple[int, int]]:
    """(end, name) of the strings of 0, size, 4 size, 16 size ... bytes after a gram."""
    h, at, n = hashlib.blake2b(g.to_bytes(8, "little", signed=True), digest_size=8), p + gram, 0
    while p + gram + n <= stop:
        h.update(raw[at:p + gram + n])
        at = p + gram + n
        yield at, int.from_bytes(h.digest(), "little", signed=True)
        n = 4 * n or size


def left_diverse(texts: DataFrame, grams: np.ndarray, size: int, gram: int) -> DataFrame:
    """Names of the strings after the grams (``_levels``) whose places differ in
    what stands before the gram, as far as a string can start there (a text's
    start differs from all others).  No maximal repeat has its first anchor at
    a gram and goes on through another string."""
    shared = texts.sparkSession.sparkContext.broadcast(grams)

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            names, side = [], []
            for raw, row, begin, end, p, g, _, b, stop in _reach(batch, shared.value, size, gram):
                if p - b > begin:
                    own = [raw[p - b - 1:p]]
                else:
                    own = [b"start" + bytes([c]) + raw[begin:end] for c in range(min(int(n[row]), 2))]
                own = [int.from_bytes(text_key(x)[:8], "little", signed=True) for x in own]
                for _, name in _levels(raw, p, g, stop, size, gram):
                    names += [name] * len(own)
                    side += own
                if len(names) >= 65536:
                    yield pa.record_batch([pa.array(names, pa.int64()), pa.array(side, pa.int64())], names=["name", "side"])
                    names, side = [], []
            yield pa.record_batch([pa.array(names, pa.int64()), pa.array(side, pa.int64())], names=["name", "side"])

    return (texts.mapInArrow(sides, "name long, side long").groupBy("name")
            .agg(F.min("side").alias("a"), F.max("side").alias("b")).where("a < b").select("name"))


OPENING = ("part long, t binary, n long, position long, low int, high int, before binary, first boolean, "
           "after binary, last boolean")


def openings(texts: DataFrame, grams: np.ndarray, diverse: np.ndarray, size: int, gram: int) -> DataFrame:
    """The anchors of the given grams inside repeats, where ``diverse`` has them:
    how many bytes before one a string may start (low to high), one byte more
    than these (reversed), and the bytes after the gram, as far as a maximal
    repeat goes and one more.  ``texts`` has the columns text, n and spans."""
    spark = texts.sparkSession
    shared, ends = spark.sparkContext.broadcast(grams), spark.sparkContext.broadcast(diverse)
    names = [x.split()[0] for x in OPENING.split(", ")]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(),
             pa.binary(), pa.bool_()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            out, held, now = [], 0, -1
            for raw, row, begin, end, p, g, a, b, stop in _reach(batch, shared.value, size, gram):
                if row != now:
                    now, t = row, text_key(raw[begin:end])
                far = list(_levels(raw, p, g, stop, size, gram))
                on = bloom.bloom_hits(ends.value, np.array([x for _, x in far], np.int64).view(np.uint64))
                if not on[0]:
                    continue
                if not on.all():
                    stop = min(stop, far[int(on.argmin())][0] + 1)
                out.append((g, t, int(n[row]), p - begin, a, b, raw[max(p - b - 1, begin):p][::-1], p - b == begin,
                            raw[p + gram:stop], stop == end))
                held += stop - p
                if len(out) >= 8192 or held > CHUNK:
                    yield pa.record_batch([pa.array(c, x) for c, x in zip(zip(*out), kinds)], names=names)
                    out, held = [], 0
            if out:
                yield pa.record_batch([pa.array(c, x) for c, x in zip(zip(*out), kinds)], names=names)

    return texts.mapInArrow(cut, OPENING)


def sliced(found: DataFrame, size: int, gram: int) -> DataFrame:
    """The anchors of hot grams, dealt out: ``SLICES`` ranges of the bytes before
    the anchor, each with the anchors that share what all its strings have."""
    extra = size - gram
    width = -(-(extra + 1) // SLICES)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g, t, n, at, a, b, before, first, after, last in zip(*(c.to_pylist() for c in batch.columns)):
                for j in range(a // width, b // width + 1):
                    most = min((j + 1) * width - 1, extra)
                    name = hashlib.blake2b(g.to_bytes(8, "little", signed=True) + bytes([j]) + before[:j * width] + b"|"
                                           + after[:extra - most], digest_size=8).digest()
                    out.append((int.from_bytes(name, "little", signed=True), t, n, at, max(a, j * width), min(b, most),
                                before, first, after, last))
                    if len(out) >= 1024:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), batch.schema)],
                                                         names=batch.schema.names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), batch.schema)],
                                                 names=batch.schema.names)

    return found.mapInArrow(deal, OPENING)


def intervals(strings: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, end) of the common-prefix intervals of sorted strings."""
    stack: list[tuple[int, int]] = []
    for k in range(1, len(strings) + 1):
        depth = common_prefix(strings[k - 1], strings[k]) if k < len(strings) else -1
        first = k - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, k
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_groups(items: list[tuple], need: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, items) of the maximal repeats that begin with this anchor.

    ``items``: low, high, before, first, after, last and the number of places.
    Each interval of what follows is split by all intervals of what stands
    before; one whose members part on both sides is a maximal repeat.  A text's
    start and end differ from all others."""
    low, high, before, first, after, last, count = (list(x) for x in zip(*items))

    def nodes(members: list[int], side: list[bytes], edge: list[bool]) -> Iterator[tuple[int, list[int]]]:
        own = [side[i] for i in members]
        for depth, a, e in intervals(own):
            yield depth, members[a:e]
        for k, i in enumerate(members):  # places of equal surroundings part at the text's edge
            if (count[i] > 1 and edge[i] and (k == 0 or own[k - 1] != own[k])
                    and (k + 1 == len(own) or not own[k + 1].startswith(own[k]))):
                yield len(own[k]), [i]

    def parts(members: list[int], side: list[bytes], edge: list[bool], depth: int) -> bool:
        least, most = min(side[i] for i in members), max(side[i] for i in members)
        return common_prefix(least, most) == depth and (
            len(least) > depth or any(edge[i] for i in members if len(side[i]) == depth))

    most = max(high)
    order = sorted(range(len(items)), key=after.__getitem__)
    for right, held in nodes(order, after, last):
        if most + right < need:
            continue
        for left, own in nodes(sorted(held, key=before.__getitem__), before, first):
            if (left + right >= need and low[own[0]] <= left <= high[own[0]]
                    and parts(own, before, first, left) and parts(own, after, last, right)):
                yield left, right, own


def maximal_repeats(docs: DataFrame, size: int = MIN_BYTES, gram: int = GRAM, hot: int = HOT,
                    bloom_bits: int = bloom.BITS) -> DataFrame:
    """repeat (id), length, t, start, doc_id: the maximal repeats of ``size``
    bytes at least, of any length, each once, with all their occurrences in all
    rows.  A repeat is found at the anchor of its first ``size`` bytes."""
    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string")).where(F.octet_length("text") >= size)
    d = d.withColumn("t", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    rows = written(d.select("doc_id", "t"), "repeats-rows")
    texts = written(d.groupBy("t").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("n")), "repeats-distinct")
    spans = repeat_spans(texts.select("text"), size, gram, hot, bloom_bits).unionByName(
        texts.where("n > 1").select("t", F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("end")))
    spans = written(spans.groupBy("t").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "repeats-spans")
    inside = written(texts.join(spans, "t").select("text", "n", "spans"), "repeats-inside")
    grams = written(repeated_grams(texts.select("text", "n"), size, gram), "repeats-grams")
    grams = bloom.bloom_filter(grams, bloom_bits)
    diverse = bloom.bloom_filter(written(left_diverse(inside, grams, size, gram), "repeats-diverse"), bloom_bits)
    found = written(openings(inside, grams, diverse, size, gram), "repeats-openings")
    many = written(found.groupBy("part").count().where(F.col("count") > hot).select("part"), "repeats-hot")
    dealt = found.join(many, "part", "left_anti").unionByName(
        sliced(found.join(many, "part", "left_semi"), size, gram))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, own in _groups(batches):
            if len(own) == 1 and own[0][2] == 1:
                continue
            places: dict[tuple, list] = {}
            for _, t, n, at, *rest in own:
                places.setdefault(tuple(rest), []).append((t, at, n))
            held = list(places.values())
            items = [(*k, sum(n for _, _, n in v)) for k, v in places.items()]
            for k, (a, b, members) in enumerate(maximal_groups(items, size - gram)):
                out = [x for i in members for x in held[i]]
                yield pa.record_batch([pa.array([f"{g & (1 << 64) - 1:016x}-{k}"] * len(out)),
                                       pa.array([a + gram + b] * len(out), pa.int64()),
                                       pa.array([t for t, _, _ in out], pa.binary()),
                                       pa.array([at - a for _, at, _ in out], pa.int64())],
                                      names=["repeat", "length", "t", "start"])

    groups = (dealt.repartition("part").sortWithinPartitions("part")
              .mapInArrow(scan, "repeat string, length long, t binary, start long"))
    return groups.join(rows, "t").select("repeat", "length", "t", "start", "doc_id")


def remove_repeats(docs: DataFrame, size: int = MIN_BYTES, gram: int = GRAM, hot: int = HOT,
                   bloom_bits: int = bloom.BITS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per input row."""
    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string")).withColumn("text", F.coalesce("text", F.lit("")))
    narrow = written(d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                              F.sha2("text", 256).alias("sha")), "repeats-texts")
    # a hot text is reduced before the shuffle
    copies = narrow.groupBy("sha").agg(F.count(F.lit(1)).alias("n"))
    spans = repeat_spans(d.where(F.octet_length("text") >= size).select("text"), size, gram, hot, bloom_bits)
    spans = written(spans.groupBy("t").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "repeats-spans")
    state = (narrow.join(copies, "sha").withColumn("t", F.unhex(F.substring("sha", 1, 32)))
             .withColumn("copied", (F.col("n") > 1) & (F.col("n_bytes") >= size)))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    whole = state.where("copied").select("doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"),
                                         F.lit(1).cast("long").alias("n_spans"), nothing.alias("kept_sha256"))
    single = state.where(~F.col("copied"))
    clean = single.join(spans, "t", "left_anti").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.col("sha").alias("kept_sha256"))
    # of the texts with spans, single ones, the rest is hashed
    ids = written(single.join(spans, "t").select("doc_id", "sha", "n_bytes", "spans"), "repeats-cut")
    a = d.select(F.col("doc_id").alias("_id"), "text", F.sha2("text", 256).alias("_sha"))
    j = a.join(ids, (F.col("_sha") == F.col("sha"))).select("doc_id", "n_bytes", "text", "spans")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, count, kept = [], [], []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                raw, at, n, k, h = text.encode(), 0, 0, 0, hashlib.sha256()
                for s, e in merge_spans([(x["start"], x["end"]) for x in spans]):
                    h.update(raw[at:s])
                    at, n, k = e, n + e - s, k + 1
                h.update(raw[at:])
                removed.append(n)
                count.append(k)
                kept.append(h.hexdigest())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                                   pa.array(count, pa.int64()), pa.array(kept, pa.string())],
                                  names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    cut = j.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return whole.unionByName(clean).unionByName(cut)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open spans; touching ones become one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out
