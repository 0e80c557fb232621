"""Similarity self-join of documents on word n-grams by prefix filtering.

A document's set holds its distinct word n-grams (hashes of 64 bits).  All
sets are put in one global order, rarest n-gram first; two sets of Jaccard
similarity t or more then share an n-gram within their prefixes, the first
n - ceil(t n) + 1 of n.  Postings of the prefixes are joined on the n-gram;
pairs are pruned by length, by position (what follows the first shared n-gram
must hold the whole intersection) and by a suffix test (bitmaps of the sets,
whose difference bounds the sets' difference from below), and each pair is
verified once on the whole sets.

The global order comes from counts over all documents of hashed n-grams
(``TABLE`` counters, a fixed size to broadcast, kept as their logarithm), then
the hash.  Any order gives the same result; the counts keep frequent n-grams
out of the prefixes.

Equal sets are one node, named by a 64-bit hash of the set, so copies are
joined once; a task writes a set's rows once, however many copies it meets.
The pairs of a posting list are not all written out: first every set is
verified against a few sets of each of its lists (stars); lists whose sets are then
of one component are done, and only pairs of different components are joined
in the second pass.  Components are what the contract asks for, and a pair
inside a component cannot change them.

Defined results: a NULL or wordless text has an empty set and links with
nothing.  A text of fewer words than n has its whole word sequence as one
n-gram.  Rows that repeat an id are one document: each keeps its own size, and
their sets share a component.  A NULL id keeps its size, with the least id of
its component (NULL where there is none).  An empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelgrowth.llm import wordhash
from panelgrowth.llm.bloom import bloom_filter, bloom_hits, merged
from panelgrowth.llm.common import components, only, written

WORDS = 4
#: Similarity as a percentage: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Counters of the frequency table and of one of its pieces.
TABLE = 1 << 22
PIECE = 1 << 16
#: 64-bit words of a set's bitmap.
WORDS_OF_MAP = 8
#: Sets of a list that all its others are verified against first.
LEADS = 3
#: Bytes of text handled at once.
CHUNK = 1 << 20
#: An n-gram of a counter beyond this many documents, and beyond this many times
#: the mean counter, is hot: its postings are dealt by set.
HOT_DOCS = 1 << 14
HOT_TIMES = 64


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct n-gram hashes, first of each text) of runs
    of whole texts."""
    data, offsets = wordhash.text_bytes(column)
    k, n = 0, len(offsets) - 1
    while k < n:
        e = max(k + 1, int(np.searchsorted(offsets, offsets[k] + CHUNK, "right")) - 1)
        h, first = wordhash.words(data[offsets[k]:offsets[e]], offsets[k:e + 1] - offsets[k], lower=True)
        yield k, *wordhash.distinct(*wordhash.shingles(h, first, words))
        k = e


def set_names(v: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit name per set, from the sum of its mixed members and its size."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(wordhash.mix64(v + np.uint64(11)))))
    return wordhash.mix64((sums[begin[1:]] - sums[begin[:-1]]) ^ np.diff(begin).astype(np.uint64)).view(np.int64)


def bitmaps(v: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(sets, WORDS_OF_MAP) parity bitmaps: each member flips the bit its hash
    names, so bits that differ are at most the members that differ, however
    large the sets are."""
    n, bits = len(begin) - 1, WORDS_OF_MAP * 64
    text = np.repeat(np.arange(n), np.diff(begin))
    count = np.bincount(text * bits + (v % np.uint64(bits)).astype(np.int64), minlength=n * bits)
    return np.packbits((count & 1).astype(bool)).view(np.int64).reshape(n, WORDS_OF_MAP)


def _binary(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """One binary value per text: its slice of ``values``."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [
        None, pa.py_buffer((begin * values.itemsize).astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())


MEASURED = "doc_id long, n_shingles long, sid long, bits array<long>, piece int, counts binary"
_MEASURED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.int64()),
                       ("bits", pa.list_(pa.int64())), ("piece", pa.int32()), ("counts", pa.binary())])


def measure(docs: DataFrame, words: int, table: int) -> DataFrame:
    """One pass over the texts: per document its size, set name (NULL for an
    empty set) and bitmap; and per task (``piece`` not NULL) the document counts
    of the hashed n-gram counters, compressed, in pieces."""
    bits = table.bit_length() - 1
    piece = min(PIECE, table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        total = np.zeros(table, np.uint32)
        for batch in batches:
            for k, v, begin in shingle_sets(batch.column(1), words):
                n = np.diff(begin)
                np.add.at(total, (v >> np.uint64(64 - bits)).astype(np.int64), 1)
                none = n == 0
                maps = bitmaps(v, begin)
                yield pa.record_batch([
                    batch.column(0).slice(k, len(n)), pa.array(n), pa.array(set_names(v, begin), mask=none),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * WORDS_OF_MAP, pa.int32()), pa.array(maps.ravel())),
                    pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], schema=_MEASURED)
        if total.any():
            z = zstandard.ZstdCompressor(level=1)
            packed = [z.compress(total[k:k + piece].tobytes()) for k in range(0, table, piece)]
            m = len(packed)
            yield pa.record_batch([pa.nulls(m, t) for t in _MEASURED.types[:4]]
                                  + [pa.array(range(m), pa.int32()), pa.array(packed, pa.binary())], schema=_MEASURED)

    return docs.mapInArrow(run, MEASURED)


def frequency_levels(measured: DataFrame, table: int) -> np.ndarray:
    """Rounded binary logarithm (times four) of each counter over all
    documents: ``table`` bytes, whatever the corpus."""

    piece = min(PIECE, table)

    def add(key, rows):
        import zstandard
        z, total = zstandard.ZstdDecompressor(), np.zeros(piece, np.uint64)
        for raw in rows.column("bits").to_pylist():
            own = z.decompress(raw)
            total += np.frombuffer(own, np.uint32 if len(own) == 4 * piece else np.uint64)
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()),
                         "bits": pa.array([zstandard.ZstdCompressor(level=1).compress(total.tobytes())])})

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            totals = [np.frombuffer(z.decompress(x), np.uint64) for x in batch.column(1).to_pylist()]
            own = [np.rint(np.log2(np.maximum(x, 1)) * 4).astype(np.uint8).tobytes() for x in totals]
            yield pa.record_batch([batch.column(0), pa.array(own, pa.binary())], names=["piece", "level"])

    blocks = measured.where("piece IS NOT NULL").select("piece", F.col("counts").alias("bits"))
    got = merged(blocks, add, "ngram-counts").mapInArrow(levels, "piece int, level binary")
    out = np.zeros(table, np.uint8)
    for k, raw in got.collect():  # ``table`` bytes in all
        out[k * piece:(k + 1) * piece] = np.frombuffer(raw, np.uint8)
    return out


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Prefix of a set of n: n - ceil(t n) + 1."""
    return n - -(-n * percent // 100) + 1


def ordered(v: np.ndarray, begin: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Each set's members in the global order, as ordered names: the counter's
    level, then 56 bits of the hash."""
    bits = len(level).bit_length() - 1
    out = (level[(v >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (v >> np.uint64(8))
    wordhash.sort_slices(out, begin)
    return out


def hot_level(level: np.ndarray) -> float:
    """The level beyond which a counter's n-grams are hot."""
    return 4 * float(np.log2(max(HOT_DOCS, HOT_TIMES * np.exp2(level / 4).mean())))


def postings(docs: DataFrame, words: int, percent: int, level: np.ndarray) -> DataFrame:
    """gram, sid, n_pos (size and position; its complement, below 0, where the
    n-gram is hot) of each prefix member of each set."""
    shared, hot = docs.sparkSession.sparkContext.broadcast(level), hot_level(level)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # sets this task has met
        for batch in batches:
            for _, v, begin in shingle_sets(batch.column(1), words):
                sid = set_names(v, begin)
                g = ordered(v, begin, shared.value)
                n = np.diff(begin)
                fresh = np.zeros(len(n), bool)
                for i, x in enumerate(sid.tolist()):
                    if n[i] and x not in seen:
                        seen.add(x)
                        fresh[i] = True
                p = np.where(fresh, prefix_length(n, percent), 0)
                text = np.repeat(np.arange(len(n)), p)
                pos = np.arange(len(text)) - np.repeat(np.cumsum(p) - p, p)
                gram = g[begin[:-1][text] + pos]
                n_pos = (n[text] << 24 | np.minimum(pos, (1 << 24) - 1)).astype(np.int64)
                yield pa.record_batch([
                    pa.array(gram.view(np.int64)), pa.array(sid[text]),
                    pa.array(np.where((gram >> np.uint64(56)) > hot, ~n_pos, n_pos))],
                    names=["gram", "sid", "n_pos"])

    return docs.mapInArrow(post, "gram long, sid long, n_pos long")


def shared_postings(posts: DataFrame) -> DataFrame:
    """The postings, one per n-gram and set, of the n-grams that several sets
    hold.  They are shuffled once, by n-gram, and read in order: a posting stays
    if one beside it is of the same n-gram.  Those of hot n-grams are dealt by
    set, so that no task holds a hot list, and all stay."""

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, on = [np.zeros(0, np.int64)] * 3, False  # the last posting, and whether it stays

        def rows(live):
            return pa.record_batch([pa.array(c[:len(live)][live]) for c in (gram, sid, np.where(n_pos < 0, ~n_pos, n_pos))],
                                   names=["gram", "sid", "n_pos"])

        for batch in batches:
            gram, sid, n_pos = (np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns))
            if not len(gram):
                continue
            first = np.ones(len(gram), bool)  # several tasks may have met a set
            first[1:] = (gram[1:] != gram[:-1]) | (sid[1:] != sid[:-1])
            gram, sid, n_pos = gram[first], sid[first], n_pos[first]
            live = n_pos < 0
            same = gram[1:] == gram[:-1]
            live[1:] |= same
            live[:-1] |= same
            live[0] |= on
            held, on = [c[-1:] for c in (gram, sid, n_pos)], bool(live[-1])
            yield rows(live[:-1])
        if on:
            gram, sid, n_pos = held
            yield rows(np.ones(1, bool))

    deal = F.when(F.col("n_pos") < 0, F.col("sid")).otherwise(F.col("gram"))
    return posts.repartition(deal).sortWithinPartitions("gram", "sid").mapInArrow(stay, "gram long, sid long, n_pos long")


def could_link(a: Column, b: Column, percent: int) -> Column:
    """Length and position filters on the ``n_pos`` of a shared member: the
    sizes are near enough, and from it on either set can still hold the
    intersection that the similarity asks for, t (na + nb) / (1 + t).  Of a pair
    that links, at least the first shared member passes."""
    na, nb = F.shiftright(a, 24), F.shiftright(b, 24)
    pa_, pb = a.bitwiseAND((1 << 24) - 1), b.bitwiseAND((1 << 24) - 1)
    return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
            & ((100 + percent) * F.least(na - pa_, nb - pb) >= percent * (na + nb)))


def near_maps(na: Column, ma: Column, nb: Column, mb: Column, percent: int) -> Column:
    """Suffix filter: bits that differ are members that differ, of which a
    linked pair has at most (1 - t) / (1 + t) (na + nb)."""
    apart = F.lit(0)
    for i in range(WORDS_OF_MAP):
        apart = apart + F.bit_count(ma[i].bitwiseXOR(mb[i]))
    return (100 + percent) * apart <= (100 - percent) * (na + nb)


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set names whose whole sets have the similarity.

    The sets are taken from the texts again, for the named sets only: a Bloom
    filter of a fixed size finds them, and a join drops its few errors.
    """
    wanted = written(pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct(),
                     "ngram-wanted")
    bloom = docs.sparkSession.sparkContext.broadcast(bloom_filter(wanted))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, v, begin in shingle_sets(batch.column(1), words):
                sid = set_names(v, begin)
                on = bloom_hits(bloom.value, sid.view(np.uint64)) & (np.diff(begin) > 0)
                for i in np.flatnonzero(on).tolist():
                    if int(sid[i]) in seen:
                        on[i] = False
                    seen.add(int(sid[i]))
                rows = np.flatnonzero(on)
                if len(rows):
                    yield pa.record_batch([pa.array(sid[rows]), _binary(v, begin).take(pa.array(rows))], names=["sid", "grams"])

    sets = docs.mapInArrow(build, "sid long, grams binary").groupBy("sid").agg(F.min("grams").alias("grams"))
    sets = written(sets, "ngram-sets")
    left = sets.select(F.col("sid").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("sid").alias("b"), F.col("grams").alias("gb"))
    j = pairs.join(left, "a").join(right, "b").select("a", "b", "ga", "gb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            ga, gb = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                z = np.concatenate([np.frombuffer(c[i].as_buffer(), np.uint64) for c in (ga, gb)])
                z.sort()
                same = int((z[1:] == z[:-1]).sum())
                keep.append(100 * same >= percent * (len(z) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return written(j.mapInArrow(check, "a long, b long"), "ngram-links")


def similar_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                       table: int = TABLE) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row."""
    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string"))
    everything = written(measure(d, words, table), "ngram-measured")
    measured = everything.where("piece IS NULL").select("doc_id", "n_shingles", "sid", "bits")
    nodes = written(measured.where("sid IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"),
        *[F.max(F.col("bits")[i]).alias(f"b{i}") for i in range(WORDS_OF_MAP)]), "ngram-nodes")
    maps = nodes.select("sid", "n", F.array(*[f"b{i}" for i in range(WORDS_OF_MAP)]).alias("bits"))
    live = written(shared_postings(postings(d, words, percent, frequency_levels(everything, table))), "ngram-live")
    # stars: every set of a list with a few of its sets, drawn by a hash
    draws = [F.min(F.struct(F.xxhash64(F.lit(r), "sid").alias("draw"), F.col("sid").alias("lead"),
                            F.col("n_pos").alias("lead_pos"))).alias(f"d{r}") for r in range(LEADS)]
    heads = live.groupBy("gram").agg(*draws).select("gram", F.explode(F.array_distinct(F.array(*[
        F.struct(f"d{r}.lead", f"d{r}.lead_pos") for r in range(LEADS)]))).alias("x")).select("gram", "x.lead", "x.lead_pos")
    stars = (live.join(heads, "gram").where("sid <> lead")
             .where(could_link(F.col("n_pos"), F.col("lead_pos"), percent))
             .select(F.least("lead", "sid").alias("a"), F.greatest("lead", "sid").alias("b")).distinct())
    side = lambda c: maps.select(F.col("sid").alias(c), F.col("n").alias("n" + c), F.col("bits").alias("m" + c))
    stars = written(stars.join(side("a"), "a").join(side("b"), "b").where(
        near_maps(F.col("na"), F.col("ma"), F.col("nb"), F.col("mb"), percent)).select("a", "b"), "ngram-stars")
    links = verified(stars, d, words, percent)
    comp = written(components(links, "a", "b"), "ngram-components-1")
    # second pass: lists with sets of different components
    named = (live.select("gram", "sid", "n_pos").join(comp.withColumnRenamed("node", "sid"), "sid", "left")
             .withColumn("component", F.coalesce("component", "sid")))
    open_ = named.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    rest = written(named.join(open_.select("gram"), "gram", "left_semi").join(maps, "sid"), "ngram-rest")
    fields = ("sid", "n_pos", "component", "n", "bits")
    x = rest.select("gram", *[F.col(c).alias("x_" + c) for c in fields])
    y = rest.select("gram", *[F.col(c).alias("y_" + c) for c in fields])
    pairs = x.join(y, (x["gram"] == y["gram"]) & (F.col("x_sid") < F.col("y_sid"))
                   & (F.col("x_component") != F.col("y_component"))
                   & could_link(F.col("x_n_pos"), F.col("y_n_pos"), percent)
                   & near_maps(F.col("x_n"), F.col("x_bits"), F.col("y_n"), F.col("y_bits"), percent))
    pairs = written(pairs.select(F.col("x_sid").alias("a"), F.col("y_sid").alias("b")).distinct()
                    .join(stars, ["a", "b"], "left_anti"), "ngram-pairs")
    if not pairs.isEmpty():
        links = links.unionByName(verified(pairs, d, words, percent))
    # rows that repeat an id tie their sets together
    ids = measured.where("sid IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("sid").alias("a"), F.max("sid").alias("z")).where("a < z")
    ties = measured.join(ids.select("doc_id", "a"), "doc_id").where("sid IS NOT NULL").select("a", F.col("sid").alias("b"))
    final = written(components(links.unionByName(ties), "a", "b"), "ngram-components")
    named = nodes.select("sid", "rep").join(final.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "component", F.coalesce("component", "sid"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    least = written(named.select(F.col("sid").alias("_sid"), "component").join(least, "component").drop("component"), "ngram-least")
    return measured.join(least, F.col("sid") == F.col("_sid"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", F.when(F.col("sid").isNull(), F.col("doc_id"))).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, table: int = TABLE,
                null_ids: bool = False) -> DataFrame:
    """The input with one row of each component: the least id, then the least
    hash of id and text.  Rows are one if id and text agree; texts that share an
    id only are not tied together.  Rows without an id stay, or with
    ``null_ids`` count like others, after all ids."""
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    key = F.col(f"c{docs.columns.index('doc_id')}").cast("long")
    text = F.col(f"c{docs.columns.index('text')}").cast("string")
    name = F.xxhash64(key.isNull(), key, text.isNull(), text)
    rows = written(named.select(name.alias("name"), key.alias("id")).distinct(), "ngram-rows")
    group = similar_components(named.select(name.alias("doc_id"), text.alias("text")), words, percent, table)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "name")).alias("x")
    stay = written(group.select(F.col("doc_id").alias("name"), "component_id").distinct().join(rows, "name")
                   .groupBy("component_id").agg(first).select(F.col("x.name").alias("_stay")), "ngram-stay")
    kept = (named.withColumn("_name", name).join(stay, F.col("_name") == F.col("_stay"), "left_semi")
            .dropDuplicates(["_name"]).drop("_name"))
    if not null_ids:
        kept = kept.where(key.isNotNull()).unionByName(named.where(key.isNull()))
    return kept.toDF(*docs.columns)
