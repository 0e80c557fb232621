"""Quality rules by distribution divergence (DataFrame functions only).

Each document's character-class and common-word histograms are compared with
a reference of its language by the Jensen-Shannon distance (base 2, 0..1).
The reference of a language is the summed histogram of all its documents that
pass the base rules, so it is a statistic of the whole corpus.  A distance is
only used on documents of a minimum length: short texts have noisy
histograms.

Defined results: a NULL or empty text has no words and fails the base rule.
A document whose language is NULL or has no word list is compared by
character classes only, with the reference of all documents of that
language value (NULL counts as a language).  Repeated rows are judged each on
its own.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelgrowth.llm.common import GAP, only, words_of, written
from panelgrowth.operators.enrich import sized_broadcast

#: Frequent words by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was",
           "with", "as", "on", "are", "be", "by", "this", "from", "at", "or"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich",
           "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une",
           "que", "est", "pour", "qui", "dans", "par", "sur", "au", "avec", "plus"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del",
           "las", "un", "por", "con", "no", "una", "para", "su", "al", "lo"],
}

#: Fixed value: symbol characters of the base rules.
SYMBOLS = "[#*$%&|<>]"

#: Character classes besides upper-case letters, white space and "the rest"
#: (letters, marks): patterns counted among the characters that are none of these.
CLASSES = {"digit": r"\p{Nd}", "symbol": r"[\p{S}#*%&|@\\/_]",
           "stop": r"[.!?]", "punct": r"[\p{P}&&[^#*%&@\\/_.!?]]"}
N_CHARS = len(CLASSES) + 3

WINDOW = 8            # words of a repeated window
MIN_WORDS = 20        # base rule
MAX_REPEAT_PCT = 30   # base rule
MIN_CHAR_WORDS = 32   # length guard of the character-class distance
MAX_CHAR_DISTANCE = 0.32
MIN_WORD_WORDS = 60   # length guard of the common-word distance
MAX_WORD_DISTANCE = 0.305


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside ``window``-word windows that occur twice or more in ``words``."""

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda p, k, x: F.get(p, k)["h"].eqNullSafe(x["h"])
        starts = let(pairs, lambda p: F.array_sort(F.transform(
            F.filter(p, lambda x, k: same(p, k - 1, x) | same(p, k + 1, x)), lambda x: x["i"])))
        return F.aggregate(
            starts, F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n")),
            lambda acc, s: F.struct(s.alias("last"),
                                    (acc["n"] + F.least(F.lit(window), s - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    # hash each word once, then join hashes over doubling spans
    def doubled(h: Column, span: int) -> Column:
        if span >= window:
            return h
        step = min(span, window - span)
        pairs = let(h, lambda x: F.zip_with(F.slice(x, F.lit(1), F.size(x) - step),
                                            F.slice(x, F.lit(step + 1), F.size(x) - step),
                                            lambda p, q: F.xxhash64(p, q)))
        return doubled(pairs, span + step)

    hashes = doubled(F.transform(words, lambda w: F.xxhash64(w)), 1)
    return F.when(F.size(words) <= window, 0).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    ).cast("long")


def _counted(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, f"(?:{pattern})+", ""))).cast("long")


def features(docs: DataFrame, carry: bool = False, hashed: bool = False) -> DataFrame:
    """Per document: base measures and the two histograms; ``carry`` adds the
    whole input row as the struct ``row``, ``hashed`` the hash of the text as
    ``text_hash`` (NULL as the empty text)."""
    if carry:
        named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        field = lambda c, kind: (F.col("row").getField(c) if c in docs.columns else F.lit(None)).cast(kind)
        d = named.select("row", field("doc_id", "long").alias("doc_id"), field("text", "string").alias("text"),
                         field("lang", "string").alias("lang"))
    else:
        d = only(docs, doc_id=("doc_id", "long"), text=("text", "string"), lang=("lang", "string"))
    d = d.withColumn("text", F.coalesce("text", F.lit("")))
    d = d.withColumn("_w", words_of(F.col("text"))).withColumn("n_words", F.size("_w").cast("long"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.regexp_replace(x, f"^{GAP}", "")) > 0)
    lists = F.create_map(*[y for k, v in COMMON_WORDS.items()
                           for y in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    known = sorted({w for v in COMMON_WORDS.values() for w in v})
    forms = sorted({*known, *(w.capitalize() for w in known)})
    common = F.transform(F.filter("_w", lambda w: w.isin(forms)), F.lower)
    word_chars = F.length(F.regexp_replace("text", GAP, "")).cast("long")
    d = (d.withColumn("word_chars", word_chars)
         .withColumn("_marks", F.regexp_replace("text", r"[\p{L}\x20\x09-\x0D]+", ""))
         .withColumn("n_symbols", _counted(F.col("_marks"), SYMBOLS))
         .withColumn("n_dup_lines", let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")))
         .withColumn("n_repeat_words", repeat_words(F.col("_w")))
         .withColumn("_counts", F.array(
             _counted(F.col("text"), r"\p{Lu}"), *[_counted(F.col("_marks"), p) for p in CLASSES.values()]))
         .withColumn("_common", let(common, lambda c: F.transform(
             lists[F.col("lang")], lambda w: (F.size(c) - F.size(F.array_remove(c, w))).cast("long")))))
    return d.select(
        *["row"] * carry, *[F.xxhash64("text").alias("text_hash")] * hashed,
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.concat("_counts", F.array(
            F.length("text") - F.col("word_chars"),
            F.col("word_chars") - F.aggregate("_counts", F.lit(0).cast("long"), lambda a, x: a + x)))
        .alias("chars"),
        F.when(F.col("_common").isNotNull(), F.concat("_common", F.array(
            F.col("n_words") - F.aggregate("_common", F.lit(0).cast("long"), lambda a, x: a + x))))
        .alias("common"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length; NULL where
    one is NULL or sums to nothing."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double"))

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def of(tp: Column, tq: Column) -> Column:
        parts = F.zip_with(p, q, lambda a, b: F.struct((a / tp).alias("a"), (b / tq).alias("b")))
        js = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + term(x["a"], (x["a"] + x["b"]) / 2)
                         + term(x["b"], (x["a"] + x["b"]) / 2))
        return F.sqrt(F.greatest(js / 2, F.lit(0.0)))

    return let(F.struct(total(p).alias("p"), total(q).alias("q")),
               lambda t: F.when((t["p"] > 0) & (t["q"] > 0), of(t["p"], t["q"])))


def _judged(docs: DataFrame, max_char: float, max_word: float, carry: bool) -> DataFrame:
    f = written(features(docs, carry), "quality-features").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
    n_common = max(map(len, COMMON_WORDS.values())) + 1
    good = ~F.col("base_failed")
    add = lambda c, i: F.coalesce(F.sum(F.when(good, F.get(F.col(c), F.lit(i)))), F.lit(0))
    # one row per language; the sums are taken map-side first
    reference = f.groupBy("lang").agg(
        F.array(*[add("chars", i) for i in range(N_CHARS)]).alias("ref_chars"),
        F.array(*[add("common", i) for i in range(n_common)]).alias("ref_common")
    ).withColumnRenamed("lang", "_lang")
    # broadcast while there are few languages: the rows, texts included, stay where they are
    reference = sized_broadcast(written(reference, "quality-reference"))
    j = f.join(reference, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    j = (j.withColumn("js_chars", js_distance(F.col("chars"), F.col("ref_chars")))
         .withColumn("js_words", js_distance(F.col("common"), F.col("ref_common"))))
    diverges = (((F.col("n_words") >= MIN_CHAR_WORDS) & F.coalesce(F.col("js_chars") > max_char, F.lit(False)))
                | ((F.col("n_words") >= MIN_WORD_WORDS)
                   & F.coalesce(F.col("js_words") > max_word, F.lit(False))))
    return j.withColumn("kept", ~F.col("base_failed") & ~diverges)


def quality_rules(docs: DataFrame, max_char: float = MAX_CHAR_DISTANCE,
                  max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """One row per input row: base measures, the two distances, ``base_failed``, ``kept``."""
    return _judged(docs, max_char, max_word, False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "js_chars", "js_words", "base_failed", "kept")


def passing(docs: DataFrame, max_char: float = MAX_CHAR_DISTANCE,
            max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """The input rows that the rules keep, with the input's columns."""
    return _judged(docs, max_char, max_word, True).where("kept").select("row.*")
