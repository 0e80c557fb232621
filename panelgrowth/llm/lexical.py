"""Ranked lexical search: a batch of items against all documents.

Score of a document for an item: the sum, over the item's distinct terms, of the
term's weight w times its impact (10^9 tf) div (1000 tf + 8 m) in the document,
all whole numbers.  The result is exact.

One pass over the texts keeps each document's terms that any item asks for, and
counts documents, terms and document frequencies.  The search then goes through
the kept rows in slices of bounded size, each indexed by itself, so that no
posting is shuffled and no posting list stands in one task.  In a slice, documents
are clustered by the similarity of their weighted vectors to pivot documents.
Every term's posting list is put in cluster order and cut into blocks, and each
block stores the greatest impact of its documents in every coordinate (of its own
term and of more frequent ones: rarer ones have lists of their own).  An item's
product with this summary is no less than the score of any document of the block
that it has not met in a rarer term's list.  A block is skipped only if that bound is below the item's k-th best score so far
(or equal to it where all its ids are greater); the documents of all others are
scored in full.  The best of each task are merged by rank.

Defined results: a NULL or empty text has no term, and such a document counts
nowhere.  An item without a term that a document holds has no row.  A NULL doc_id
comes after all others.  Rows that repeat an id or a text are documents (or
items) of their own.  An empty table of either side gives an empty result.  Extra
columns are ignored.  Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelgrowth.llm import wordhash
from panelgrowth.llm.common import empty_like, only, written

TOP = 10
#: Items (and bytes of them) of one pass over the documents.
ITEMS_OF_PASS = 4096
BYTES_OF_PASS = 64 << 20
#: Items whose terms are the coordinates of an index, and terms of them, about.
ITEMS_OF_INDEX = 64
TERMS_OF_INDEX = 2048
#: Documents of a slice, of a block, and of a cluster run that gets blocks of its own.
SLICE_DOCS = 4096
BLOCK_DOCS = 32
RUN_DOCS = 8
#: Numbers in a slice's vectors and summaries, and of them taken at once to build these.
CELLS = 32_000_000
EXPANDED = 1 << 20
LAST = (1 << 63) - 1

#: Characters between terms: ASCII other than letters and digits.
GAPS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
RESULT = "item_id long, rank int, doc_id long, score long"
KEPT = "doc_id long, n long, terms array<int>, tfs array<int>, stats boolean"


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of each text, in order, and each text's first one."""
    return wordhash.words(*wordhash.text_bytes(column), lower=True, gaps=GAPS)


def _lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def item_terms(items: DataFrame) -> DataFrame:
    """uid, item_id, terms: the distinct term hashes of each item, written."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, first = wordhash.distinct(*text_terms(batch.column(2)))
            yield pa.record_batch([batch.column(0), batch.column(1), _lists(terms.view(np.int64), first, pa.int64())],
                                  names=["uid", "item_id", "terms"])

    d = only(items, item_id=("item_id", "long"), text=("text", "string"))
    d = d.select(F.monotonically_increasing_id().alias("uid"), "item_id", "text")
    return written(d.mapInArrow(read, "uid long, item_id long, terms array<long>"), "item-terms")


def keep_terms(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """doc_id, n, terms (numbers into ``wanted``, sorted hashes), tfs of each
    document that holds one; and of each task a row ``stats``: documents with a
    term, their terms, and the documents that hold each wanted term."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, n_terms, df = 0, 0, np.zeros(len(wanted), np.int64)
        names = ["doc_id", "n", "terms", "tfs", "stats"]
        for batch in batches:
            h, first = text_terms(batch.column(1))
            n = np.diff(first)
            n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
            at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            hit = wanted[at] == h
            doc = np.repeat(np.arange(len(n)), n)[hit]
            key, tf = np.unique(doc << 32 | at[hit], return_counts=True)
            doc, term = key >> 32, key & (1 << 32) - 1
            df += np.bincount(term, minlength=len(wanted))
            some, size = np.unique(doc, return_counts=True)
            if len(some):
                bounds = np.concatenate(([0], np.cumsum(size)))
                yield pa.record_batch([batch.column(0).take(pa.array(some)), pa.array(n[some]), _lists(term, bounds, pa.int32()),
                                       _lists(tf, bounds, pa.int32()), pa.array(np.zeros(len(some), bool))], names=names)
        held = np.flatnonzero(df)
        if n_docs:
            yield pa.record_batch([pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()),
                                   _lists(held, np.array([0, len(held)]), pa.int32()),
                                   _lists(df[held], np.array([0, len(held)]), pa.int32()), pa.array([True])], names=names)

    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string"))
    return written(d.mapInArrow(read, KEPT), "lexical-kept")


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents of n terms."""
    if int(n.max(initial=0)) * n_docs * 90 < 1 << 63:
        return 10 + n * (90 * n_docs) // n_terms
    return np.array([10 + 90 * x * n_docs // n_terms for x in n.tolist()], np.int64)


class SliceIndex:
    """Blocked posting lists of a slice over the terms ``columns`` of the items,
    rarest first.

    ``vectors``: impacts, a row a document (whole numbers below 2^24, exact as
    floats).  ``blocks``: per column, the numbers of its first block and of the
    one after its last; ``summary``: a row a block, the maxima of its documents in the
    coordinates from the block's own term on.  Rarer terms are left out: a document that
    holds one the item asks for is met in that term's list, where its bound has all
    its terms, so the lists of common terms answer only for documents without a
    rarer one."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, weights: np.ndarray, block_docs: int = BLOCK_DOCS):
        self.ids, self.vectors = ids, vectors
        n, width = vectors.shape
        cluster, rank = self.clusters(vectors * weights.astype(np.float32))
        row, column = np.nonzero(vectors)
        value = vectors[row, column]
        end_of_row = np.cumsum(np.bincount(row, minlength=n))[row]
        order = np.argsort(column * n + rank[row], kind="stable")
        self.doc, term = row[order], column[order]
        group = term * (int(cluster.max(initial=0)) + 1) + cluster[self.doc]
        self.first = self.cut(term, group, block_docs)
        self.ends = np.concatenate((self.first[1:], [len(self.doc)]))
        self.blocks = np.searchsorted(term[self.first], np.arange(width + 1))
        self.least_id = np.minimum.reduceat(ids[self.doc], self.first) if len(self.first) else ids[:0]
        self.summary = np.zeros((len(self.first), width), np.float32)
        # each posting brings the rest of its document's row, from its own term on
        block = np.repeat(np.arange(len(self.first)), self.ends - self.first)
        size = end_of_row[order] - order
        until = np.cumsum(size)
        k = 0
        while k < len(order):
            e = max(k + 1, int(np.searchsorted(until, until[k] - size[k] + EXPANDED, "right")))
            own, begin = size[k:e], np.cumsum(size[k:e]) - size[k:e]
            at = np.arange(int(own.sum())) + np.repeat(order[k:e] - begin, own)
            np.maximum.at(self.summary.reshape(-1), np.repeat(block[k:e] * width, own) + column[at], value[at])
            k = e

    @staticmethod
    def clusters(weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each document's most similar pivot (by cosine), and its rank by pivot and similarity."""
        n = len(weighted)
        pivots = np.arange(0, n, max(int(math.sqrt(n)), 1))
        unit = weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
        like = unit @ unit[pivots].T
        cluster = like.argmax(1)
        rank = np.empty(n, np.int64)
        rank[np.lexsort((-like[np.arange(n), cluster], cluster))] = np.arange(n)
        return cluster, rank

    @staticmethod
    def cut(term: np.ndarray, group: np.ndarray, block_docs: int) -> np.ndarray:
        """First postings of the blocks: runs of one cluster, short ones together, of ``block_docs`` at most."""
        if not len(term):
            return np.zeros(0, np.int64)
        run = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        large = np.diff(np.concatenate((run, [len(term)]))) >= RUN_DOCS
        new = np.concatenate(([True], (term[run[1:]] != term[run[:-1]]) | large[1:] | large[:-1]))
        start = run[new]
        at = np.arange(len(term)) - np.repeat(start, np.diff(np.concatenate((start, [len(term)]))))
        return np.flatnonzero(at % block_docs == 0)

    def search(self, columns: np.ndarray, weights: np.ndarray, best: "Best") -> int:
        """Adds the slice's documents to an item's best (``columns``: its terms,
        ascending); how many blocks were opened."""
        spans = [np.arange(self.blocks[c], self.blocks[c + 1]) for c in columns.tolist()]
        blocks = np.concatenate(spans) if spans else np.zeros(0, np.int64)
        bound = (self.summary[np.ix_(blocks, columns)].astype(np.float64) @ weights).astype(np.int64)
        order = np.argsort(-bound, kind="stable")
        blocks, bound = blocks[order], bound[order]
        seen = np.zeros(len(self.ids), bool)
        k, step, opened = 0, 2, 0
        while k < len(blocks) and bound[k] > 0 and bound[k] >= best.score:
            e = min(k + step, len(blocks))
            own = blocks[k:e]
            own = own[(bound[k:e] > best.score) | (bound[k:e] == best.score) & (self.least_id[own] <= best.id)]
            opened += len(own)
            docs = np.unique(np.concatenate([self.doc[self.first[b]:self.ends[b]] for b in own.tolist()] or [self.doc[:0]]))
            docs = docs[~seen[docs]]
            seen[docs] = True
            if len(docs):
                scores = (self.vectors[np.ix_(docs, columns)].astype(np.float64) @ weights).astype(np.int64)
                best.add(self.ids[docs], scores)
            k, step = e, min(2 * step, 16)
        return opened


class Best:
    """The k best (score, id) of an item.  ``score`` and ``id`` are those a document must reach."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, 0, LAST
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        on = scores >= max(self.score, 1)
        ids, scores = np.concatenate((self.ids, ids[on])), np.concatenate((self.scores, scores[on]))
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]
        if len(order) == self.k:
            self.score, self.id = int(self.scores[-1]), int(self.ids[-1])


def item_groups(terms: list[np.ndarray]) -> list[tuple[list[int], np.ndarray]]:
    """Items (numbers) in groups, each with the union of its terms."""
    out, own, union = [], [], np.zeros(0, np.int64)
    for i, t in enumerate(terms):
        more = np.union1d(union, t)
        if own and (len(own) >= ITEMS_OF_INDEX or len(more) > TERMS_OF_INDEX):
            out.append((own, union))
            own, more = [], np.unique(t)
        own, union = own + [i], more
    return out + [(own, union)] if own else out


def search_kept(kept: DataFrame, terms: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int,
                k: int = TOP, slice_docs: int = SLICE_DOCS) -> DataFrame:
    """item (number), doc_id, score, opened, blocks: the best of each task."""
    groups = item_groups(terms)

    def index_and_search(ids, vectors, group, union, best, told) -> None:
        columns = np.flatnonzero(vectors.any(0))
        columns = columns[np.argsort(-weights[union[columns]], kind="stable")]  # rarest first
        cells = len(columns) * (len(ids) + np.count_nonzero(vectors) // BLOCK_DOCS + len(columns))
        if cells > CELLS and len(ids) > 1:  # too many terms for one index: half the documents each
            h = len(ids) // 2
            index_and_search(ids[:h], vectors[:h], group, union, best, told)
            index_and_search(ids[h:], vectors[h:], group, union, best, told)
            return
        have = union[columns]
        index = SliceIndex(ids, vectors[:, columns], weights[have]) if len(ids) > 1 else None
        for i in group:
            own = np.flatnonzero(np.isin(have, terms[i], assume_unique=True))
            w = weights[have[own]].astype(np.float64)
            if index is None:  # a document alone is its own block
                best[i].add(ids, (vectors[:, columns[own]].astype(np.float64) @ w).astype(np.int64))
            elif len(own):
                told[0] += index.search(own, w, best[i])
                told[1] += int((index.blocks[own + 1] - index.blocks[own]).sum())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {i: Best(k) for i in range(len(terms))}
        told = [0, 0]
        for batch in batches:
            n = batch.column(1).to_numpy()
            m = length_norm(n, n_docs, n_terms)
            lists, tfs = batch.column(2), batch.column(3)
            first = lists.offsets.to_numpy().astype(np.int64)
            term, tf = lists.values.to_numpy(), tfs.values.to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(n)), np.diff(first))
            term, tf = term[first[0]:first[-1]], tf[int(tfs.offsets[0].as_py()):][:first[-1] - first[0]]
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
            ids = batch.column(0).fill_null(LAST).to_numpy()
            for group, union in groups:
                at = np.minimum(np.searchsorted(union, term), len(union) - 1)
                hit = union[at] == term
                gd, gt, gi = doc[hit], at[hit], impact[hit]
                rows = np.unique(gd)
                size = max(1, min(slice_docs, CELLS // max(len(union), 1)))
                for s in range(0, len(rows), size):
                    own = rows[s:s + size]
                    x, y = np.searchsorted(gd, [own[0], own[-1] + 1])
                    vectors = np.zeros((len(own), len(union)), np.float32)
                    vectors[np.searchsorted(own, gd[x:y]), gt[x:y]] = gi[x:y]
                    index_and_search(ids[own], vectors, group, union, best, told)
        item = np.repeat(np.arange(len(terms)), [len(best[i].ids) for i in range(len(terms))])
        if len(item):
            out = np.concatenate([best[i].ids for i in range(len(terms))])
            yield pa.record_batch([pa.array(item, pa.int32()), pa.array(out, mask=out == LAST),
                                   pa.array(np.concatenate([best[i].scores for i in range(len(terms))])),
                                   pa.array(np.where(np.arange(len(item)) == 0, told[0], 0)),
                                   pa.array(np.where(np.arange(len(item)) == 0, told[1], 0))],
                                  names=["item", "doc_id", "score", "opened", "blocks"])

    return kept.select("doc_id", "n", "terms", "tfs").mapInArrow(
        search, "item int, doc_id long, score long, opened long, blocks long")


def search_tasks(docs: DataFrame, items: DataFrame, k: int = TOP, slice_docs: int = SLICE_DOCS) -> DataFrame:
    """uid, item_id, doc_id, score, opened, blocks: the best of each task, for
    every item, in as many passes over the documents as there are blocks of items."""
    spark = docs.sparkSession
    asked = item_terms(items)
    n_items, n_hashes = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).head()
    passes = max(-(-n_items // ITEMS_OF_PASS), -(-8 * n_hashes // BYTES_OF_PASS))
    out = empty_like(spark, "uid long, item_id long, doc_id long, score long, opened long, blocks long")
    for p in range(passes):
        own = asked.where(F.pmod(F.xxhash64("uid"), F.lit(passes)) == p).orderBy("uid").collect()  # of bounded size
        hashes = [np.array(r["terms"], np.int64).view(np.uint64) for r in own]
        wanted = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
        if not len(wanted):
            continue
        kept = keep_terms(docs, wanted)
        stats = kept.where("stats")
        n_docs, n_terms = stats.agg(F.sum("doc_id"), F.sum("n")).head()
        if not n_docs:
            continue
        df = np.zeros(len(wanted), np.int64)
        pairs = stats.select(F.explode(F.arrays_zip("terms", "tfs")).alias("x")).groupBy("x.terms").agg(
            F.sum("x.tfs").alias("n"))
        for r in pairs.collect():  # a row a wanted term
            df[r["terms"]] = r["n"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        terms = [np.searchsorted(wanted, h) for h in hashes]
        found = search_kept(kept.where("NOT stats"), terms, weights, n_docs, n_terms, k, slice_docs)
        names = spark.createDataFrame([(i, r["uid"], r["item_id"]) for i, r in enumerate(own)], "item int, uid long, item_id long")
        out = out.unionByName(found.join(F.broadcast(names), "item").drop("item"))
    return out


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, slice_docs: int = SLICE_DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the highest score of each item."""
    best = search_tasks(docs, items, k, slice_docs)
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


#: The same result in SQL.
ORACLE_SQL = r"""WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), lens AS (
  SELECT rid, doc_id, len(terms) AS n FROM words WHERE len(terms) > 0
), whole AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lens
), tfs AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM words) GROUP BY rid, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, whole GROUP BY term, n_docs
), asked AS (
  SELECT DISTINCT uid, item_id, term FROM (
    SELECT row_number() OVER () AS uid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
), scored AS (
  SELECT a.uid, a.item_id, l.rid, l.doc_id,
    sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * l.n * whole.n_docs) // whole.n_terms))))::BIGINT AS score
  FROM asked a JOIN weights w USING (term) JOIN tfs t USING (term) JOIN lens l ON l.rid = t.rid, whole
  GROUP BY a.uid, a.item_id, l.rid, l.doc_id
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 10"""
