"""Alignment of two tokenizers over a corpus, with corpus-wide pair counts.

Every text is encoded by a byte-level BPE (side A, of a space and the text) and
a piece model (side B, of the text; the model adds the space).  Both tokens
lists cover the same bytes.  Offsets where a token of either side ends cut them
into groups; an A and a B occurrence whose byte ranges overlap are linked.  A
pair's count is the number of documents that hold it linked.

Counting is external.  A task cuts its documents into slices of bounded size.
The pair-document records of a slice are radix-partitioned by the low bits of
the A id into runs, sorted by (A id, B id, document), compressed with zstd and
spilled to one file of the shared folder.  Only a run's keys, with its number of
documents a pair, are shuffled (pre-aggregated: a pair is one record a slice,
however many of its documents hold it).  A k-way heap merge of at most
``FAN_IN`` runs at a time counts the pairs of each bucket, in as many rounds as
it takes.  As runs are in A order, an A id's counts come out together with their
maximum.  The counts then stream back over the runs to each slice, whose
spilled records turn them into the documents' sums.

Defined results: a NULL or empty text, and one whose joined token bytes differ
from a space and the text on either side, has no tokens: zeros and ''.  Rows
that repeat an id or a text are documents of their own and count each.  An empty
table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrowth.llm.common import only, shared_folder, written
from panelgrowth.llm.files import new_name, open_in, open_out

#: Documents and records at which a slice ends (a document is never cut).
SLICE_DOCS = 1 << 14
SLICE_RECORDS = 4_000_000
#: Runs that one merge opens.
FAN_IN = 64
#: Words whose alignment a worker remembers, and pairs of them.
CACHE_WORDS = 400_000
CACHE_PAIRS = 8_000_000
DOC_BITS = 14

RUNS = "slice string, bucket int, keys binary, `offset` long, length long"
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")
_BASE = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("n_links", pa.int64()), ("groups_sha256", pa.string())])


def byte_characters() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes its bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Aligner:
    """Both tokenizers, and the alignment of words seen before.

    A single space between two characters that are not white space starts a new
    token on both sides: of A by its pre-tokenizer, of B as no piece has a space
    after its first character.  So the alignment of such a text is those of its
    words, each with the space before it.  Other texts are aligned as a whole.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n_a, n_b = self.a.get_vocab_size(with_added_tokens=True), self.b.get_piece_size()
        code = byte_characters()
        self.bytes_a = [bytes(code[c] for c in t) if all(c in code for c in t) else t.encode()
                        for t in (self.a.id_to_token(i) or "" for i in range(n_a))]
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.starts_a = np.array([x.startswith(b" ") for x in self.bytes_a])
        self.by_words = not any("▁" in p[1:] and p.strip("▁") for p in pieces)
        self.odd = re.compile(r"\s |\s\Z| \s")
        self.clear()

    def clear(self) -> None:
        """Forgets all entries.  Entry 0 is that of a word that cannot be aligned."""
        self.known: dict[str, int] = {}
        self.groups: list[str] = [""]
        self.counts = [np.array([[-1, 0, 0, 0]], np.int64)]  # tokens of A and B, groups, links
        self.pairs = [np.zeros((0, 2), np.uint32)]
        self.n_pairs = 0
        self.tables = None

    def full(self) -> bool:
        return len(self.groups) > CACHE_WORDS or self.n_pairs > CACHE_PAIRS

    def sure(self, ids_a: list[list[int]], ids_b: list[list[int]], wanted: list[bytes]) -> np.ndarray:
        """Which entries have, on both sides, the wanted bytes."""
        whole = b"".join(wanted)
        size = np.array([len(w) for w in wanted], np.int64)
        good = np.ones(len(wanted), bool)
        for ids, table, length in ((ids_a, self.bytes_a, self.len_a), (ids_b, self.bytes_b, self.len_b)):
            flat = np.array([i for x in ids for i in x], np.int64)
            first = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)
            total = np.concatenate(([0], np.cumsum(length[flat])))
            same = np.diff(total[first]) == size
            if same.all() and b"".join([table[i] for i in flat.tolist()]) == whole:
                continue
            good &= np.array([b"".join([table[i] for i in x]) == w for x, w in zip(ids, wanted)], bool)
        return good

    def add(self, ids_a: list[list[int]], ids_b: list[list[int]], wanted: list[bytes]) -> list[int]:
        """Entries of word (or text) encodings; 0 where the bytes differ."""
        good = self.sure(ids_a, ids_b, wanted)
        at = np.flatnonzero(good).tolist()
        out = np.zeros(len(wanted), np.int64)
        out[good] = len(self.groups) + np.arange(len(at))
        if at:
            a, b = (np.array([i for k in at for i in ids[k]], np.int64) for ids in (ids_a, ids_b))
            end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
            lo = np.searchsorted(end_b, end_a - self.len_a[a], "right")
            hi = np.searchsorted(end_b - self.len_b[b], end_a, "left")
            links = hi - lo
            left = np.repeat(np.arange(len(a)), links)
            right = np.arange(len(left)) - np.repeat(np.cumsum(links) - links, links) + lo[left]
            self.pairs.append(np.stack((a[left], b[right]), 1).astype(np.uint32))
            self.n_pairs += len(left)
            in_b = np.searchsorted(end_b, end_a)
            cut = end_b[in_b] == end_a
            cut_a, cut_b = np.flatnonzero(cut) + 1, in_b[cut] + 1
            said_a, said_b = (list(map(str, x.tolist())) for x in (a, b))
            parts, i, j = [], 0, 0
            for i2, j2 in zip(cut_a.tolist(), cut_b.tolist()):
                parts.append(",".join(said_a[i:i2]) + "|" + ",".join(said_b[j:j2]))
                i, j = i2, j2
            # every entry ends at a cut
            n_a, n_b = (np.array([len(ids[k]) for k in at], np.int64) for ids in (ids_a, ids_b))
            last = np.searchsorted(cut_a, np.cumsum(n_a), "right")
            first = np.concatenate(([0], last[:-1]))
            linked = np.concatenate(([0], np.cumsum(links)))[np.cumsum(n_a)]
            self.groups += [";".join(parts[x:y]) for x, y in zip(first.tolist(), last.tolist())]
            self.counts.append(np.stack((n_a, n_b, last - first, np.diff(linked, prepend=0)), 1))
        self.tables = None
        return out.tolist()

    def learn(self, words: list[str]) -> None:
        for k in range(0, len(words), 20_000):
            some = words[k:k + 20_000]
            ids = np.array(self.a.encode(" " + " ".join(some), add_special_tokens=False).ids, np.int64)
            cut = np.flatnonzero(self.starts_a[ids])
            if len(cut) == len(some):
                flat, at = ids.tolist(), [*cut.tolist(), len(ids)]
                ids_a = [flat[x:y] for x, y in zip(at, at[1:])]
            else:  # a vocabulary of another kind
                ids_a = [e.ids for e in self.a.encode_batch([" " + w for w in some], add_special_tokens=False)]
            found = self.add(ids_a, self.b.encode(some, num_threads=1), [b" " + w.encode() for w in some])
            self.known.update(zip(some, found))

    def whole(self, text: str) -> int:
        return self.add([self.a.encode(" " + text, add_special_tokens=False).ids],
                        [self.b.encode(text)], [b" " + text.encode()])[0]

    def entries(self, texts: list[str | None]) -> list[list[int]]:
        """Each text's entries; none where it has no tokens.  They hold until ``clear``."""
        split = [None if not self.by_words or not t or t[0] == " " or self.odd.search(t) else t.split(" ") for t in texts]
        get = self.known.get
        rows = [s and list(map(get, s)) for s in split]
        new = {w for s, r in zip(split, rows) if s and None in r for w, e in zip(s, r) if e is None}
        if new:
            self.learn(list(new))
        out = []
        for t, s, r in zip(texts, split, rows):
            if s is None:
                r = [self.whole(t)] if t else []
            elif None in r:
                r = [self.known[w] if e is None else e for w, e in zip(s, r)]
            out.append([] if 0 in r else r)
        return out

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(counts, pairs, first pair) of the entries."""
        if self.tables is None:
            self.counts, self.pairs = [np.concatenate(self.counts)], [np.concatenate(self.pairs)]
            first = np.concatenate(([0], np.cumsum(self.counts[0][:, 3]))).astype(np.int64)
            self.tables = self.counts[0], self.pairs[0], first
        return self.tables


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner_of(path_a: str, path_b: str) -> Aligner:
    """One aligner per Python worker: later tasks find the words known."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


class Layout:
    """Bits of a 64-bit record: A id (its low bits, the bucket, first), B id,
    document of the slice, occurrences."""

    def __init__(self, n_a: int, n_b: int, buckets: int):
        self.a, self.b, self.radix = (max(n - 1, 1).bit_length() for n in (n_a, n_b, buckets))
        self.occ = 64 - self.a - self.b - DOC_BITS
        if self.occ < 1 or self.radix > self.a:
            raise ValueError("the vocabularies need too many bits")

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, r = a.astype(np.uint64), np.uint64(self.radix)
        low = a & np.uint64((1 << self.radix) - 1)
        return (low << np.uint64(self.a - self.radix) | a >> r) << np.uint64(self.b) | b.astype(np.uint64)

    def unpair(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = pair >> np.uint64(self.b)
        high = a & np.uint64((1 << (self.a - self.radix)) - 1)
        return high << np.uint64(self.radix) | a >> np.uint64(self.a - self.radix), pair & np.uint64((1 << self.b) - 1)

    def bucket(self, pair: np.ndarray) -> np.ndarray:
        return pair >> np.uint64(self.a - self.radix + self.b)


def squeeze(*columns: np.ndarray) -> bytes:
    """Equally long columns as one zstd block, by planes of bytes."""
    import zstandard
    raw = b"".join(c.view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in map(np.ascontiguousarray, columns))
    return zstandard.ZstdCompressor(level=1).compress(raw)


def stretch(block: bytes, *kinds: str) -> list[np.ndarray]:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, out, at = len(raw) // sum(sizes), [], 0
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=np.zeros(1, values.dtype))


class Slice:
    """Documents of a task until they are spilled."""

    def __init__(self, layout: Layout):
        self.layout = layout
        self.base: list[tuple] = []
        self.held: list[np.ndarray] = []
        self.n = 0

    def add(self, aligner: Aligner, ids: list, rows: list[list[int]]) -> None:
        """Documents by their entries: base columns now, records kept."""
        counts, pairs, first = aligner.table()
        said = aligner.groups
        size = np.array([len(r) for r in rows], np.int64)
        flat = np.fromiter(chain.from_iterable(rows), np.int64, int(size.sum()))
        doc = np.repeat(np.arange(len(rows)), size)
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(counts[flat], 0)))
        sums = np.diff(sums[np.concatenate(([0], np.cumsum(size)))], axis=0)
        for doc_id, own, row in zip(ids, sums.tolist(), rows):
            sha = hashlib.sha256(";".join([said[e] for e in row]).encode()).hexdigest() if row else ""
            self.base.append((doc_id, *own, sha))
        # words of a document once, with their number, then their pairs
        entry, times = np.unique(doc << 40 | flat, return_counts=True)
        doc, entry = entry >> 40, entry & (1 << 40) - 1
        links = counts[entry, 3]
        left = np.repeat(np.arange(len(entry)), links)
        at = np.arange(len(left)) - np.repeat(np.cumsum(links) - links, links) + first[entry][left]
        own = pairs[at]
        key = self.layout.pair(own[:, 0], own[:, 1]) << np.uint64(DOC_BITS)
        key |= (doc[left] + len(self.base) - len(rows)).astype(np.uint64)
        key, times, most = key << np.uint64(self.layout.occ), times[left].astype(np.uint64), np.uint64((1 << self.layout.occ) - 1)
        while (over := times > most).any():  # more occurrences than the bits hold: several records
            self.held.append(key[over] | most)
            times = np.where(over, times - most, times)
        self.held.append(self._reduced([key | times]))
        self.n += len(self.held[-1])

    def _reduced(self, parts: list[np.ndarray]) -> np.ndarray:
        """Sorted records, equal (pair, document) added up while the bits hold it."""
        key = np.concatenate(parts)
        key.sort()
        occ = np.uint64(self.layout.occ)
        own = key >> occ
        at = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
        times = np.add.reduceat(key & np.uint64((1 << self.layout.occ) - 1), at) if len(at) else own
        return key if (times >> occ).any() else own[at] << occ | times

    def spill(self, folder: str, name: str) -> list[tuple]:
        """Writes the runs and the base columns; the manifest rows."""
        layout = self.layout
        key = np.concatenate(self.held) if self.held else np.zeros(0, np.uint64)
        key.sort()
        own, times = key >> np.uint64(layout.occ), key & np.uint64((1 << layout.occ) - 1)
        if len(own):
            at = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            own, times = own[at], np.add.reduceat(times, at)
        pair, doc = own >> np.uint64(DOC_BITS), (own & np.uint64((1 << DOC_BITS) - 1)).astype(np.uint16)
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, np.int64)
        pairs, bounds = pair[first], np.concatenate((first, [len(pair)]))
        buckets = layout.bucket(pairs).astype(np.int64)
        edge = np.searchsorted(buckets, np.arange((1 << layout.radix) + 1))
        rows, offset = [], 0
        with open_out(folder, name) as out:
            base = pa.table([list(c) for c in zip(*self.base)], schema=_BASE)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _BASE, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(base)
            blob = sink.getvalue().to_pybytes()
            out.write(blob)
            rows.append((name, -1, None, offset, len(blob)))
            offset += len(blob)
            for k in range(1 << layout.radix):
                x, y = int(edge[k]), int(edge[k + 1])
                if x == y:
                    continue
                i, j = int(bounds[x]), int(bounds[y])
                docs = np.diff(bounds[x:y + 1]).astype(np.uint32)
                blob = squeeze(doc[i:j], times[i:j].astype(np.uint32)) if times[i:j].max() < 1 << 32 else b""
                blob = blob or squeeze(doc[i:j], times[i:j])
                out.write(blob)
                rows.append((name, k, squeeze(_steps(pairs[x:y]), docs), offset, len(blob)))
                offset += len(blob)
        return rows


def spill_runs(docs: DataFrame, path_a: str, path_b: str, buckets: int,
               slice_docs: int = SLICE_DOCS, slice_records: int = SLICE_RECORDS) -> tuple[str, DataFrame]:
    """Spills the slices' runs; returns their folder and manifest (``RUNS``;
    bucket -1 are a slice's documents)."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "align-runs")
    slice_docs = min(slice_docs, 1 << DOC_BITS)

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, own, layout = None, None, None

        def ended(x: Slice) -> pa.RecordBatch:
            rows = x.spill(folder, new_name("slice", ".runs"))
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.int64()))],
                names=["slice", "bucket", "keys", "offset", "length"])

        for batch in batches:
            if aligner is None:
                aligner = aligner_of(path_a, path_b)
                layout = Layout(len(aligner.bytes_a), len(aligner.bytes_b), buckets)
            ids, text = batch.column(0).to_pylist(), batch.column(1)
            k = 0
            while k < len(ids):
                some, n = [], 0
                while k + len(some) < len(ids) and len(some) < 128 and n < 1 << 20:
                    some.append(text[k + len(some)].as_py())
                    n += len(some[-1] or "")
                if aligner.full():
                    aligner.clear()
                if own and len(own.base) + len(some) > slice_docs:
                    yield ended(own)
                    own = None
                own = own or Slice(layout)
                own.add(aligner, ids[k:k + len(some)], aligner.entries(some))
                k += len(some)
                if own.n >= slice_records:
                    yield ended(own)
                    own = None
        if own:
            yield ended(own)

    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string"))
    return folder, written(d.mapInArrow(spill, RUNS), "align-manifest")


def heap_merge(runs: list[tuple[np.ndarray, np.ndarray]], b_bits: int) -> Iterator[tuple]:
    """Merges runs (pairs ascending, numbers) by A id: for each in order, its
    distinct pairs, their sums, and (run, from, to, place among the pairs) of
    each run that has it."""
    heads, heap = [], []
    for i, (pairs, _) in enumerate(runs):
        a = pairs >> np.uint64(b_bits)
        cut = [0, *(np.flatnonzero(a[1:] != a[:-1]) + 1).tolist()] if len(a) else []
        heads.append(zip(a[cut].tolist(), cut, [*cut[1:], len(a)]))
        if head := next(heads[i], None):
            heap.append((head[0], i, head[1], head[2]))
    heapq.heapify(heap)
    while heap:
        a, own = heap[0][0], []
        while heap and heap[0][0] == a:
            _, i, x, y = heap[0]
            own.append((i, x, y))
            head = next(heads[i], None)
            if head:
                heapq.heapreplace(heap, (head[0], i, head[1], head[2]))
            else:
                heapq.heappop(heap)
        if len(own) == 1:
            i, x, y = own[0]
            yield runs[i][0][x:y], runs[i][1][x:y].astype(np.int64), [(i, x, y, slice(None))]
            continue
        pairs, place = np.unique(np.concatenate([runs[i][0][x:y] for i, x, y in own]), return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, place, np.concatenate([runs[i][1][x:y] for i, x, y in own]).astype(np.int64))
        at, parts = 0, []
        for i, x, y in own:
            parts.append((i, x, y, place[at:at + y - x]))
            at += y - x
        yield pairs, sums, parts


def _opened(blocks: list[bytes], count: str) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.cumsum(p, dtype=np.uint64), n) for p, n in (stretch(b, "<u8", count) for b in blocks)]


def _spread(runs: DataFrame, groups: int) -> DataFrame:
    return runs.withColumn("part", F.pmod(F.xxhash64("slice"), F.lit(max(groups, 1))).cast("int"))


def count_pairs(runs: DataFrame, b_bits: int, fan_in: int = FAN_IN) -> DataFrame:
    """bucket, keys: each bucket's pairs with their numbers of documents, one
    row a bucket, merged at most about ``fan_in`` runs at a time."""

    def merge(count: str):
        def one(key, rows):
            pairs, sums = [], []
            for p, n, _ in heap_merge(_opened(rows.column("keys").to_pylist(), count), b_bits):
                pairs.append(p)
                sums.append(n)
            blob = squeeze(_steps(np.concatenate(pairs)), np.concatenate(sums))
            return pa.table({"slice": [f"merged-{key[1].as_py()}"], "bucket": pa.array([key[0].as_py()], pa.int32()),
                             "keys": [blob]})
        return one

    runs, count = runs.select("slice", "bucket", "keys"), "<u4"
    while True:
        most = runs.groupBy("bucket").count().agg(F.max("count")).head()[0] or 0
        groups = -(-most // fan_in)
        merged = written(_spread(runs, groups).groupBy("bucket", "part").applyInArrow(
            merge(count), "slice string, bucket int, keys binary"), "align-merged")
        if groups <= 1:
            return merged.select("bucket", "keys")
        runs, count = merged, "<i8"


def stream_back(runs: DataFrame, totals: DataFrame, b_bits: int, fan_in: int = FAN_IN) -> DataFrame:
    """slice, bucket, counts: of every run, in its order, the pairs' counts and
    whether each is the highest of its A id."""
    most = runs.groupBy("bucket").count().agg(F.max("count")).head()[0] or 0
    spread = _spread(runs.select("slice", "bucket", "keys"), -(-most // fan_in))
    whole = spread.select("bucket", "part").distinct().join(totals, "bucket").select(
        F.lit(None).cast("string").alias("slice"), "bucket", "keys", "part")

    def back(key, rows):
        names, blocks = rows.column("slice").to_pylist(), rows.column("keys").to_pylist()
        all_pairs, counts = _opened([blocks.pop(names.index(None))], "<i8")[0]
        names.remove(None)
        own = _opened(blocks, "<u4")
        found = [np.empty(len(p), np.int64) for p, _ in own]
        best = [np.empty(len(p), np.uint8) for p, _ in own]
        # the totals as the last run: each A id's segment of them has its maximum
        for pairs, _, parts in heap_merge([*own, (all_pairs, counts)], b_bits):
            i, x, y, _ = parts[-1]  # runs come in order, and the totals have every pair
            top, sums = counts[x:y].max(), counts[x:y]
            for i, x, y, place in parts[:-1]:
                found[i][x:y] = sums[place]
                best[i][x:y] = sums[place] == top
        return pa.table({"slice": pa.array(names, pa.string()), "bucket": pa.array([key[0].as_py()] * len(names), pa.int32()),
                         "counts": pa.array([squeeze(f, b) for f, b in zip(found, best)], pa.binary())})

    return spread.unionByName(whole).groupBy("bucket", "part").applyInArrow(
        back, "slice string, bucket int, counts binary")


def document_sums(folder: str, manifest: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents' columns: each slice's spilled records meet their counts."""
    have = manifest.select("slice", "bucket", "offset", "length", F.when(
        F.col("bucket") >= 0, F.col("keys")).alias("keys"), F.lit(None).cast("binary").alias("counts"))
    sent = counts.select("slice", "bucket", F.lit(None).cast("long").alias("offset"),
                         F.lit(None).cast("long").alias("length"), F.lit(None).cast("binary").alias("keys"), "counts")

    def one(key, rows):
        runs, told = {}, {}
        for r in rows.to_pylist():
            if r["counts"] is not None:
                told[r["bucket"]] = r["counts"]
            else:
                runs[r["bucket"]] = r
        with open_in(folder, key[0].as_py()) as source:
            def read(r):
                source.seek(r["offset"])
                return source.read(r["length"])
            with pa.ipc.open_stream(read(runs.pop(-1))) as s:
                base = s.read_all()
            n_best, count_sum = (np.zeros(base.num_rows, np.int64) for _ in range(2))
            for k, r in runs.items():
                count, best = stretch(told[k], "<i8", "u1")
                _, n = stretch(r["keys"], "<u8", "<u4")
                block = read(r)
                total = int(n.sum())
                doc, times = _records(block, total)
                pair = np.repeat(np.arange(len(n)), n)
                np.add.at(count_sum, doc, count[pair] * times)
                on = best[pair].astype(bool)
                np.add.at(n_best, doc[on], times[on])
        out = {c: base.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(out | {"n_best": n_best, "count_sum": count_sum, "groups_sha256": base.column("groups_sha256")})

    return have.unionByName(sent).groupBy("slice").applyInArrow(one, RESULT)


def _records(block: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    import zstandard
    size = zstandard.get_frame_parameters(block).content_size
    doc, times = stretch(block, "<u2", "<u4" if size == 6 * n else "<u8")
    return doc.astype(np.int64), times.astype(np.int64)


class Alignment:
    """Runs and pair counts of a corpus; ``documents()`` and ``pairs()`` read them."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, buckets: int | None = None,
                 slice_docs: int = SLICE_DOCS, slice_records: int = SLICE_RECORDS, fan_in: int = FAN_IN):
        aligner = aligner_of(path_a, path_b)
        n_a, n_b = len(aligner.bytes_a), len(aligner.bytes_b)
        if not buckets:  # as many as there are shuffle partitions, about
            parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            buckets = 1 << min(max(parts, 64).bit_length(), 12)
        self.layout, self.fan_in = Layout(n_a, n_b, buckets), fan_in
        self.folder, self.manifest = spill_runs(docs, path_a, path_b, buckets, slice_docs, slice_records)
        self.runs = self.manifest.where("bucket >= 0")
        self.totals = count_pairs(self.runs, self.layout.b, fan_in)

    def documents(self) -> DataFrame:
        """``RESULT`` of every document."""
        back = stream_back(self.runs, self.totals, self.layout.b, self.fan_in)
        return document_sums(self.folder, self.manifest, back)

    def pairs(self) -> DataFrame:
        """a, b, n_docs: every linked id pair and its number of documents."""
        layout = self.layout

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for blob in batch.column(0):
                    pairs, n = _opened([blob.as_py()], "<i8")[0]
                    a, b = layout.unpair(pairs)
                    yield pa.record_batch([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n)],
                                          names=["a", "b", "n_docs"])

        return self.totals.select("keys").mapInArrow(read, "a int, b int, n_docs long")


def align_tokens(docs: DataFrame, path_a: str, path_b: str, **options) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return Alignment(docs, path_a, path_b, **options).documents()
