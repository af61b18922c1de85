"""Quality rules with thresholds that follow each language and source.

Four rates of every document are summarised by quantile sketches with bounded
relative error (DDSketch; Masson et al., 2019): counts by logarithmic bucket, which
merge by addition.  The quartiles of a language and source give its fences; a group
with few documents takes the merged sketch of its language, and a small language
that of all documents.  Documents outside a fence are rejected.

Column functions only: words, windows and lines are arrays inside the row, so the
text is read once and never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import stored

WINDOW = 8
SPACE = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
ZERO = -1_000_000  # bucket of values that are not above zero
LEAST_ROWS = 100  # of a group that has fences of its own
WIDTH = 8.0  # of a fence, in distances from the median to a quartile
#: rate: (which side is rejected, least distance that counts between median and quartile)
RATES = {
    "symbol_rate": (1, 0.02),  # symbols for each word
    "upper_rate": (1, 0.025),  # A-Z for each character of a word
    "duplicate_rate": (1, 0.02),  # lines equal to an earlier one, for each word
    "variety": (-1, 0.02),  # log of distinct words over log of words
}


def measured(docs: DataFrame, *carried: Column) -> DataFrame:
    """The documents' doc_id, lang, source with counts over the whole text (null: none).

    ``carried`` are further columns of ``docs`` to keep.
    """
    own = [c.alias(f"carried_{k}") for k, c in enumerate(carried)]
    names = ["doc_id", "lang", "source", *(f"carried_{k}" for k in range(len(own)))]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select(
        "doc_id",
        F.col("lang").cast("string"),
        F.col("source").cast("string"),
        *own,
        F.length(text).alias("chars"),
        (F.size(F.split(text, SYMBOL, -1)) - 1).alias("n_symbols"),
        (F.size(F.split(text, "[A-Z]", -1)) - 1).alias("n_upper"),
        F.split(text, SPACE, -1).alias("parts"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE[1:]}")).alias("lines"),
    )
    hashed = F.transform(F.filter("parts", lambda w: w != ""), lambda w: F.xxhash64(w))
    df = df.select(
        *names, "n_symbols", "n_upper",
        (F.col("chars") - F.size("parts") + 1).alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        hashed.alias("words"),
    )
    windows = F.when(
        F.size("words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size("words") - WINDOW + 1),
            lambda k: F.xxhash64(F.slice("words", k, WINDOW)),
        ),
    )
    df = df.withColumn("n_words", F.size("words")).withColumn("windows", windows)
    df = df.withColumn("distinct", F.size(F.array_distinct("words")))
    # most texts repeat no window; only the others are sorted
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda x, k: F.struct(x.alias("h"), k.alias("k"))))
    df = df.drop("words").withColumn("sorted", F.when(repeats, placed)).drop("windows")

    def twice(x: Column, k: Column) -> Column:
        s = F.col("sorted")
        return F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
            F.get(s, k + 1)["h"] == x["h"], F.lit(False)
        )

    places = F.sort_array(F.transform(F.filter("sorted", twice), lambda x: x["k"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, k: F.struct((a["n"] + F.least(F.lit(WINDOW), k - a["last"])).alias("n"), k.alias("last")),
        lambda a: a["n"],
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0))).drop("sorted")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "distinct"]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.select(
        *names, *(F.col(c).cast("long") for c in counts), failed.alias("base_failed")
    )


def rated(measures: DataFrame) -> DataFrame:
    """The measures with one column for each rate; a text without words has zeros."""
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    rates = {
        "symbol_rate": F.col("n_symbols") / words,
        "upper_rate": F.col("n_upper") / F.when(F.col("word_chars") > 0, F.col("word_chars")),
        "duplicate_rate": F.col("n_dup_lines") / words,
        "variety": F.log(F.col("distinct").cast("double")) / F.when(words > 1, F.log(words.cast("double"))),
    }
    return measures.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in rates.items()})


def sketched(df: DataFrame, keys: list[str], rates: list[str]) -> DataFrame:
    """(keys, rate, bucket, n): a mergeable sketch of each rate in each group."""

    def bucket(x: Column) -> Column:
        return F.when(x > 0, F.ceil(F.log(x) / math.log(GAMMA))).otherwise(ZERO).cast("int")

    cells = F.explode(F.array(*(F.struct(F.lit(r).alias("rate"), bucket(F.col(r)).alias("bucket")) for r in rates)))
    cells = df.select(*keys, cells.alias("c")).select(*keys, "c.rate", "c.bucket")
    return cells.groupBy(*keys, "rate", "bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups: counts of equal buckets add up."""
    return sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rate, rows, q1, q2, q3) of each sketch; its buckets are few whatever the rows."""
    group = Window.partitionBy(*keys, "rate")
    so_far = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.when(F.col("bucket") == ZERO, 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1))
    df = sketch.withColumn("cum", F.sum("n").over(so_far)).withColumn("rows", F.sum("n").over(group))
    df = df.withColumn("value", middle)
    at = [F.min(F.when(F.col("cum") * 4 >= F.col("rows") * k, F.col("value"))).alias(f"q{k}") for k in (1, 2, 3)]
    return df.groupBy(*keys, "rate").agg(F.max("rows").alias("rows"), *at)


def fences(df: DataFrame) -> DataFrame:
    """(lang, source, a fence for each rate): the bound beyond which a document is rejected."""
    fine = stored(sketched(df, ["lang", "source"], list(RATES)), "sketch")
    own = quartiles(fine, ["lang", "source"])
    by_lang = quartiles(merged(fine, ["lang"]), ["lang"])
    whole = quartiles(merged(fine, []), [])

    def as_struct(q: DataFrame, name: str, keys: list[str]) -> DataFrame:
        return q.select(*keys, "rate", F.struct("rows", "q1", "q2", "q3").alias(name))

    a, b, c = as_struct(own, "a", ["lang", "source"]), as_struct(by_lang, "b", ["lang"]), as_struct(whole, "c", [])
    same = F.col("l.lang").eqNullSafe(F.col("r.lang")) & (F.col("l.rate") == F.col("r.rate"))
    all_three = a.alias("l").join(b.alias("r"), same).select("l.*", "b").join(c, "rate")
    best = F.when(F.col("a.rows") >= LEAST_ROWS, F.col("a")).otherwise(
        F.when(F.col("b.rows") >= LEAST_ROWS, F.col("b")).otherwise(F.col("c"))
    )
    q = all_three.withColumn("q", best)
    fence = F.lit(None).cast("double")
    for rate, (side, least) in RATES.items():
        step = F.col("q.q3") - F.col("q.q2") if side > 0 else F.col("q.q2") - F.col("q.q1")
        fence = F.when(
            F.col("rate") == rate, F.col("q.q2") + side * WIDTH * F.greatest(step, F.lit(least))
        ).otherwise(fence)
    q = q.withColumn("fence", fence)
    return q.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("rate") == r, F.col("fence"))).alias(f"{r}_fence") for r in RATES)
    )


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, base_failed, the rates and fences, and kept.

    Null and empty texts fail the base rule.  Null languages and sources are groups like
    any other.  Ties at a fence are kept; repeated rows count as often as they occur.
    """
    df = stored(rated(measured(docs)), "measures")
    return _fenced(df, fences(df.where("not base_failed")))


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Rows are written with their counts before the verdict: a filter pushed into the array
    expressions would evaluate them again for every element.
    """
    whole = F.struct(*(F.col(c) for c in docs.columns))
    df = stored(rated(measured(docs, whole)), "measures")
    bounds = stored(fences(df.where("not base_failed")), "fences")
    return _fenced(df, bounds).where("kept").select("carried_0.*")


def _fenced(df: DataFrame, bounds: DataFrame) -> DataFrame:
    same = F.col("l.lang").eqNullSafe(F.col("r.lang")) & F.col("l.source").eqNullSafe(F.col("r.source"))
    joined = df.alias("l").join(bounds.alias("r"), same, "left").drop(F.col("r.lang"), F.col("r.source"))
    inside = ~F.col("base_failed")
    for rate, (side, _) in RATES.items():
        ok = F.col(rate) <= F.col(f"{rate}_fence") if side > 0 else F.col(rate) >= F.col(f"{rate}_fence")
        inside = inside & F.coalesce(ok, F.lit(True))
    return joined.withColumn("kept", inside)
