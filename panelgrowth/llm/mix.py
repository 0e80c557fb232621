"""Mixing sources to target weights (DataFrame functions only).

Efraimidis-Spirakis sampling: every document draws u from a hash of its id
and gets the exponential key -ln(u) / weight, weight being its quality.
Within a source, documents in key order are prefix-summed to the token
budget.  A budget above the source's size takes complete epochs first; only
the rest is a fractional selection.

No source is gathered in one task.  Keys fall into key bins, about one per
``BIN_ROWS`` documents of the source; bins are summed map-side, the bin in
which the budget ends is found on the bin table and cut again while it is large
(bins are even at weight 1 only), and only the last cut's rows are ordered.  The decision is then one comparison per document with its source's
cut.

Defined results: a NULL or blank text has size 0 and is never taken.  NULL is
a source of its own, last in order.  Rows that repeat id and size are one
document with a multiplicity: all of them are taken or left together.  Ties
of the key are broken by id and size.  An empty table gives an empty mix.
Extra columns are ignored by ``mix_plan`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelgrowth.llm.common import only, word_count, written
from panelgrowth.operators.frame import frame_index

#: Weights given to the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target stops at this many times its size.
MAX_EPOCHS = 3
#: Rows per key bin, about.
BIN_ROWS = 4096
SEED = "mix-1"
#: Mean characters per word at which the quality weight is 1.
MEAN_WORD = 6.0


def quality_weight(text: Column, size: Column) -> Column:
    """Document quality in (0, 1]: falls with the distance of the mean word
    length (separators included) from ``MEAN_WORD``."""
    return F.when(size > 0, F.lit(1.0) / (F.lit(1.0) + F.abs(
        F.length(text).cast("double") / size.cast("double") - F.lit(MEAN_WORD))))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight with u in (0, 1) from 52 bits of an md5 of the id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2 ** 52))) / weight


def source_key(source: Column) -> Column:
    """Sort key of a source: code-point order, NULL last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, src (source key), size, key: the narrow table the mix works on."""
    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string"), source=("source", "string"))
    d = d.withColumn("size", word_count(F.col("text")))
    return d.select("doc_id", source_key(F.col("source")).alias("src"), "size",
                    sampling_key(F.col("doc_id"), quality_weight(F.col("text"), F.col("size")), seed)
                    .alias("key"))


def source_targets(rows: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """src, source_size, n_docs, target: the total size shared by weight; no
    target above ``max_epochs`` times its source, the excess reshared."""
    sizes = written(rows.groupBy("src").agg(F.sum("size").alias("source_size"),
                                            F.count(F.lit(1)).alias("n_docs")), "mix-sources")
    ranked, _ = frame_index(sizes, ["src"], name="_rank")
    i = F.col("_rank") % len(weights)
    w = F.lit(weights[-1])
    for k in range(len(weights) - 1):
        w = F.when(i == k, F.lit(weights[k])).otherwise(w)
    s = written(ranked.withColumn("w", w.cast("long")).withColumn(
        "most", F.col("source_size") * max_epochs), "mix-ranked")
    total = s.agg(F.sum("source_size")).head()[0] or 0
    # a few scalars per round; the capped set only grows, so this ends
    capped, left, wsum, n = F.lit(False), total, None, -1
    while True:
        got = s.agg(F.count(F.when(capped, 1)), F.coalesce(F.sum(F.when(capped, F.col("most"))), F.lit(0)),
                    F.coalesce(F.sum(F.when(~capped, F.col("w"))), F.lit(0))).head()
        if got[0] == n:
            break
        n, left, wsum = got[0], total - got[1], got[2]
        if not wsum:
            break
        capped = (F.lit(left).cast("long") * F.col("w")).cast("double") / F.lit(float(wsum)) > F.col("most")
    share = (F.lit(left).cast("long") * F.col("w")).cast("double") / F.lit(float(wsum or 1))
    return s.select("src", "source_size", "n_docs",
                    F.when(capped, F.col("most").cast("double")).otherwise(share).alias("target"))


def source_cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """targets plus, per source: epochs and the cut, the last (key, doc_id,
    size) of the fractional selection (NULL: none)."""
    t = (targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("n_bins", F.ceil(F.col("n_docs") / F.lit(BIN_ROWS)).cast("long")))
    # rows that repeat id and size are one document; a hot one collapses map-side
    d = (rows.where("size > 0").groupBy("src", "key", "doc_id", "size")
         .agg(F.sum("size").alias("words")).join(t.select("src", "n_bins"), "src")
         .withColumn("bin", F.floor(F.col("n_bins") * (F.lit(1.0) - F.exp(-F.col("key")))).cast("long")))
    d = written(d.drop("n_bins"), "mix-binned")
    bins = d.groupBy("src", "bin").agg(F.sum("words").alias("words"))
    run = Window.partitionBy("src").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    last = (bins.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
            .join(t.select("src", "rest"), "src")
            .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
            .select("src", "bin", "before", "rest"))
    order = F.struct("key", "doc_id", "size")
    # bins are even at weight 1 only: the last one is cut again until it is small;
    # done: the last document of what was cut off before it
    held = written(d.join(last, ["src", "bin"]).withColumn("done", F.when(F.lit(False), order)), "mix-last")
    while True:
        span = held.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        span = span.where((F.col("n") > 2 * BIN_ROWS) & (F.col("lo") < F.col("hi"))).withColumn(
            "parts", F.ceil(F.col("n") / F.lit(BIN_ROWS)).cast("long"))
        if span.isEmpty():
            break
        sub = F.least(F.floor((F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("parts")), F.col("parts") - 1)
        h = held.join(span, "src", "left").withColumn("sub", F.coalesce(sub, F.lit(0)).cast("long"))
        run = Window.partitionBy("src").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
        subs = (h.groupBy("src", "sub").agg(F.sum("words").alias("sum"), F.max(order).alias("top"), F.min("before").alias("start"))
                .withColumn("at", F.col("start") + F.coalesce(F.sum("sum").over(run), F.lit(0)))
                .withColumn("prior", F.max("top").over(run)))
        one = h.join(subs.select("src", "sub", "sum", "at", "prior"), ["src", "sub"]).where(
            (F.col("at") < F.col("rest")) & (F.col("at") + F.col("sum") >= F.col("rest")))
        held = written(one.select("src", "bin", "key", "doc_id", "size", "words", F.col("at").alias("before"), "rest",
                                  F.coalesce("prior", "done").alias("done")), "mix-last")
    inside = Window.partitionBy("src").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    # the document in which the budget ends is taken if that comes nearer to it
    cut = (held.withColumn("at", F.col("before") + F.coalesce(F.sum("words").over(inside), F.lit(0)))
           .groupBy("src").agg(F.coalesce(F.max(F.when(F.col("at") + F.col("words") / 2 <= F.col("rest"), order)),
                                          F.max("done")).alias("cut"), F.first("bin").alias("cut_bin")))
    # nothing of the last bin taken: everything before it is
    return (t.join(cut, "src", "left")
            .select("src", "source_size", "target", "epochs", "cut", "cut_bin", "n_bins"))


def mix_plan(docs: DataFrame, seed: str = SEED, weights: tuple = WEIGHTS,
             max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, src, size, source_size, target, takes (times the document is in
    the mix) and taken (its words times takes); one row per input row."""
    rows = written(sized(docs, seed), "mix-sized")
    cuts = written(source_cuts(rows, source_targets(rows, weights, max_epochs)), "mix-cuts")
    return _decided(rows, cuts)


def _decided(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    bin_ = F.floor(F.col("n_bins") * (F.lit(1.0) - F.exp(-F.col("key")))).cast("long")
    order = F.struct("key", "doc_id", "size")
    picked = (F.col("size") > 0) & ((bin_ < F.col("cut_bin"))
                                    | ((bin_ == F.col("cut_bin")) & F.coalesce(order <= F.col("cut"), F.lit(False))))
    j = rows.join(cuts, "src", "left").withColumn("takes", F.when(
        F.col("size") > 0, F.col("epochs") + F.when(picked, 1).otherwise(0)).otherwise(F.lit(0)).cast("long"))
    return j.select("doc_id", "src", "size", "source_size", "target", "takes",
                    (F.col("size") * F.col("takes")).alias("taken"))


def mix(docs: DataFrame, seed: str = SEED, weights: tuple = WEIGHTS,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed documents with the input's columns: each row as often as it
    is taken.  The cuts are one row per source, so no text is shuffled where
    Spark finds that table small."""
    rows = written(sized(docs, seed), "mix-sized")
    cuts = written(source_cuts(rows, source_targets(rows, weights, max_epochs)), "mix-cuts")
    kept = docs.columns
    named = docs.toDF(*[f"c{i}" for i in range(len(kept))])
    at = {c: f"c{i}" for i, c in enumerate(kept)}
    col = lambda c, kind: (F.col(at[c]) if c in at else F.lit(None)).cast(kind)
    size = word_count(col("text", "string"))
    d = (named.withColumn("size", size)
         .withColumn("doc_id", col("doc_id", "long"))
         .withColumn("src", source_key(col("source", "string")))
         .withColumn("key", sampling_key(F.col("doc_id"), quality_weight(col("text", "string"), F.col("size")), seed)))
    bin_ = F.floor(F.col("n_bins") * (F.lit(1.0) - F.exp(-F.col("key")))).cast("long")
    picked = (bin_ < F.col("cut_bin")) | ((bin_ == F.col("cut_bin")) & F.coalesce(
        F.struct("key", "doc_id", "size") <= F.col("cut"), F.lit(False)))
    j = d.join(cuts, "src").where("size > 0").withColumn(
        "_takes", (F.col("epochs") + F.when(picked, 1).otherwise(0)).cast("int"))
    return (j.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_takes"))))
            .select(*[F.col(f"c{i}") for i in range(len(kept))]).toDF(*kept))
