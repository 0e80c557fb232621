"""Token-id files: Arrow files of fixed-size-list batches.

The ids of all documents, in ascending doc_id order, are one stream, cut into
files at document ends.  A file holds its stream as sequences of
``SEQ_LEN`` ids (``tokens``: fixed-size list of uint16, or uint32 for a
vocabulary beyond 65,536 ids) with a ``mask`` (fixed-size list of bits, 0 in the
padding of the last sequence).  All batches
but the last have ``BATCH_SEQS`` sequences, so sequence k of a file is row
k % BATCH_SEQS of batch k // BATCH_SEQS, and its ids are a slice of the mapped
file: nothing is copied or decoded.  The file's documents (id, first id,
number of ids) are in an index file of the same name.

Defined results: a NULL or empty text is the end id alone.  Documents with a
NULL id come first.  Rows that repeat an id follow each other, ordered by a
hash of the text.  An empty table gives no file and an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelgrowth.llm.common import only, shared_folder, written
from panelgrowth.llm.files import new_name, open_in, open_out

SEQ_LEN = 2048
BATCH_SEQS = 256
END_ID = 2
#: A file is closed at the first document end beyond this many ids.
FILE_IDS = 16 << 20
#: Words whose ids a task remembers.
CACHE_WORDS = 1_000_000
#: Characters of the texts whose parts are counted off together.
BLOCK_CHARS = 16 << 20
#: Latin letters, then ASCII marks.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]*)")
#: The byte-level character of each byte that is not its own.
BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}


def file_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("tokens", pa.list_(id_type, SEQ_LEN)), ("mask", pa.list_(pa.bool_(), SEQ_LEN))])


INDEX_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, file_no int, name string, n_docs long, n_ids long"


class Encoder:
    """Ids of whole texts by a tokenizers file, remembering words.

    A space between two characters that are not white space always starts a
    new piece of the byte-level pre-tokenizer, so a text's ids are the ids of
    its space-separated parts, each but the first with its space.  The parts of
    a block of texts are counted off once (Arrow's dictionary), and only its
    distinct ones are looked up.  A new part of Latin letters and then ASCII
    marks is two pieces at most, which go to the tokenizer's model at once; other
    new parts are encoded together, and told apart by the ids that
    start with the space byte.  A text with any other use of spaces is encoded
    as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        n = self.n_ids = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.starts = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(n)])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        spec = json.loads(self.tokenizer.to_str())
        self.model = self.tokenizer.model
        # pieces are known in advance only for this pre-tokenizer, and where no
        # added token can lie in letters and marks
        self.plain = (spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                                                "use_regex": True}
                      and spec["normalizer"] is None and not spec["model"].get("dropout")
                      and all(re.search(r"[!-/:-@\[-`{-~]\w", t["content"]) for t in spec["added_tokens"]))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, letters: str) -> bytes:
        """Ids of one piece of the pre-tokenizer, in its characters."""
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, parts: list[str]) -> None:
        if len(self.known) + len(parts) > CACHE_WORDS // 2:  # words not met since the last time are forgotten
            self.known, self.older = {}, self.known
        rest = parts
        if self.plain:
            rest, known, marks = [], self.known, self.marks
            for p in parts:
                m = PLAIN.fullmatch(p)
                if not m:
                    rest.append(p)
                    continue
                word, end = m.groups()
                own = known.get(word) or self.older.get(word)
                if own is None:
                    own = self.piece("Ġ" + (word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS)))
                known[word] = own
                if end:
                    if end not in marks:
                        if len(marks) > CACHE_WORDS // 10:
                            marks.clear()
                        marks[end] = self.piece(end)
                    known[p] = own + marks[end]
        for k in range(0, len(rest), 20_000):
            some = rest[k:k + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(self.starts[ids])
            if len(cut) != len(some):  # a vocabulary of another kind
                for p in some:
                    self.known[p] = self.whole(" " + p)
                continue
            raw, at = ids.tobytes(), [*(cut * 4).tolist(), len(ids) * 4]
            for p, a, b in zip(some, at, at[1:]):
                self.known[p] = raw[a:b]

    def spaced(self, parts: list[str]) -> list[bytes | None]:
        """Ids of distinct parts, each with its space; None where white space
        stands beside it."""
        out = list(map(self.known.get, parts))
        if None in out:
            new, older = [], self.older.get
            for i, v in enumerate(out):
                if v is None:
                    v = out[i] = older(parts[i])
                    if v is None:
                        p = parts[i]
                        if p and not p[0].isspace() and not p[-1].isspace():
                            new.append(i)
                    else:
                        self.known[parts[i]] = v
            for k in range(0, len(new), 20_000):
                some = new[k:k + 20_000]
                self.learn([parts[i] for i in some])
                for i in some:
                    out[i] = self.known[parts[i]]
        return out

    def block(self, texts: list[str]) -> list[bytes]:
        """Ids of texts; those whose spaces are not all single ones between
        words are encoded as a whole."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        at = split.offsets.to_numpy()
        flat = split.values
        later = np.ones(len(flat), bool)
        later[at[:-1]] = False
        first = flat.take(pa.array(at[:-1])).to_pylist()
        coded = flat.filter(pa.array(later)).dictionary_encode()
        ids = self.spaced(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy()
        begin = at - np.arange(len(at))  # a text's parts but its first
        odd = [False] * len(first)
        if None in ids:
            n = np.concatenate(([0], np.cumsum(np.array([v is None for v in ids])[code])))[begin]
            odd, ids = (n[1:] > n[:-1]).tolist(), [v or b"" for v in ids]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(ids), "<u4")
        size = size[code]
        end = np.concatenate(([0], np.cumsum(size)))
        place = np.repeat(start[code] - end[:-1], size)
        place += np.arange(end[-1])
        stream = ids[place].tobytes()
        cut = (end[begin] * 4).tolist()
        return [self.whole(t) if o or f[-1].isspace() else self.whole(f) + stream[a:b]
                for t, f, o, a, b in zip(texts, first, odd, cut, cut[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        rows, n = [], 0
        for i, t in enumerate(texts):
            if not t:
                continue
            if t[0] == " " or "  " in t or t[-1].isspace():
                out[i] = self.whole(t)
                continue
            if rows and n + len(t) > BLOCK_CHARS:
                for j, own in zip(rows, self.block([texts[j] for j in rows])):
                    out[j] = own
                rows, n = [], 0
            rows.append(i)
            n += len(t)
        if rows:
            for j, own in zip(rows, self.block([texts[j] for j in rows])):
                out[j] = own
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder per Python worker: later tasks find the words known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class FileWriter:
    """One token file and its index."""

    def __init__(self, folder: str, part: int, file_no: int, n_ids: int = 1 << 32):
        self.kind = (pa.uint16(), np.uint16) if n_ids <= 1 << 16 else (pa.uint32(), np.uint32)
        self.schema = file_schema(self.kind[0])
        self.part, self.file_no, self.folder = part, file_no, folder
        self.name = new_name(f"tokens-{part:05d}-{file_no:05d}", "")
        self.out = open_out(folder, self.name + ".arrow")
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.held: list[bytes] = []
        self.held_ids = 0
        self.ids = 0
        self.docs: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append((doc_id, self.ids, n))
        self.held.append(ids)
        self.ids += n
        self.held_ids += n
        if self.held_ids >= SEQ_LEN * BATCH_SEQS:
            self._write(False)

    def _write(self, last: bool) -> None:
        data = np.frombuffer(b"".join(self.held), "<u4")
        size = SEQ_LEN * BATCH_SEQS
        full = len(data) // size * size
        for k in range(0, full, size):
            self._batch(data[k:k + size], size)
        rest = data[full:]
        if last and len(rest):
            pad = -len(rest) % SEQ_LEN
            self._batch(np.concatenate((rest, np.zeros(pad, "<u4"))), len(rest))
            rest = rest[:0]
        self.held, self.held_ids = [rest.tobytes()], len(rest)

    def _batch(self, ids: np.ndarray, real: int) -> None:
        tokens = pa.array(ids.astype(self.kind[1]))
        mask = pa.array(np.arange(len(ids)) < real)
        self.file.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(x, SEQ_LEN) for x in (tokens, mask)], schema=self.schema))

    def close(self) -> tuple:
        self._write(True)
        self.file.close()
        self.out.close()
        index = pa.table(list(map(list, zip(*self.docs))), schema=INDEX_SCHEMA)
        with open_out(self.folder, self.name + ".index.arrow") as out, pa.ipc.new_file(out, INDEX_SCHEMA) as f:
            f.write_table(index)
        return self.part, self.file_no, self.name, len(self.docs), self.ids


class TokenFile:
    """Random access to a token file: sequences and masks as views of the file."""

    def __init__(self, folder: str, name: str):
        self.source = open_in(folder, name + ".arrow")
        self.file = pa.ipc.open_file(self.source)
        with open_in(folder, name + ".index.arrow") as f:
            self.index = pa.ipc.open_file(f).read_all()

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """(ids, mask) of sequence k: a view of the file, and its mask bits."""
        batch = self.file.get_batch(k // BATCH_SEQS)
        at = k % BATCH_SEQS * SEQ_LEN
        return (batch.column(0).values.to_numpy(zero_copy_only=True)[at:at + SEQ_LEN],
                batch.column(1).values.slice(at, SEQ_LEN))

    def stream(self) -> Iterator[np.ndarray]:
        """The file's ids, batch after batch, without the padding."""
        for k in range(self.file.num_record_batches):
            batch = self.file.get_batch(k)
            yield batch.column(0).flatten().to_numpy()[:batch.column(1).flatten().true_count]


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None,
                      end_id: int = END_ID, file_ids: int = FILE_IDS) -> tuple[str, DataFrame]:
    """Writes the token files of ``docs``; returns their folder and manifest
    (part, file_no, name, n_docs, n_ids, start: ids in the files before)."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")
    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string")).withColumn(
        "_tie", F.xxhash64("text"))
    # range partitions in order of the id; the tie keeps a repeated id from one partition
    ordered = d.repartitionByRange(_partitions(d), "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, file_no, writer, rows = TaskContext.get().partitionId(), 0, None, []
        encoder = None
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            encoder = encoder or encoder_of(tokenizer)
            ids = encoder.encode(batch.column(1).to_pylist())
            for doc_id, own in zip(batch.column(0).to_pylist(), ids):
                writer = writer or FileWriter(folder, part, file_no, max(encoder.n_ids, end_id + 1))
                writer.add(doc_id, own + end)
                if writer.ids >= file_ids:
                    rows.append(writer.close())
                    writer, file_no = None, file_no + 1
        if writer:
            rows.append(writer.close())
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows)],
                                  names=["part", "file_no", "name", "n_docs", "n_ids"]).cast(pa.schema([
                                      ("part", pa.int32()), ("file_no", pa.int32()), ("name", pa.string()),
                                      ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    manifest = written(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    # one row per file, not per document
    run = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    return folder, manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(run), F.lit(0)))


def _partitions(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def read_token_files(folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                f = TokenFile(folder, row["name"])
                index = f.index
                start, n = (index.column(c).to_numpy() for c in ("start", "n_tokens"))
                crc = np.zeros(len(n), np.int64)
                doc, at = 0, 0  # ids of a document may lie in several batches
                for ids in f.stream():
                    begin = 0
                    while begin < len(ids):
                        take = min(int(start[doc] + n[doc]) - at, len(ids) - begin)
                        crc[doc] = zlib.crc32(ids[begin:begin + take].astype("<u4").tobytes(), int(crc[doc]))
                        begin, at = begin + take, at + take
                        doc += at == start[doc] + n[doc]
                yield pa.record_batch([index.column("doc_id").combine_chunks(), pa.array(start + row["start"]),
                                       pa.array(n), pa.array(crc)],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("name", "start")
    return files.repartition(_partitions(files), "name").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the files, reads them back: doc_id, start, n_tokens, ids_crc32."""
    folder, manifest = write_token_files(docs, tokenizer)
    return read_token_files(folder, manifest)
