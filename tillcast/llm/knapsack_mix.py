"""Mixing sources to target weights by subset-sum budget fitting.

Every source has a budget of words.  It takes all its documents as often as the
budget holds them, then the documents of each exact length in proportion, and a
bounded-knapsack program over the lengths that remain fits what is left of the
budget.  The program sees only a histogram of lengths; the documents of a length
are chosen by a seeded hash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import WORD, stored

REPEATS = 3
WEIGHTS = (1, 2, 3)
PROGRAM = 1 << 14  # words held back for the program; if more are left, they are taken greedily
PROGRAM_LONG = 1 << 18  # at most, where twice the longest text is above PROGRAM
GROUP = 10_000  # documents ranked together


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of every whole text; null has none."""
    size = F.size(F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD), F.lit(0)))
    return docs.select("doc_id", F.col("source").cast("string"), size.cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = REPEATS) -> DataFrame:
    """(source, source_size, target): budgets that share all sizes by weight.

    Sources in order of code point, null last, have the weights in turn.  A target is
    at most ``most`` times its source; the excess goes to the others by weight.  With
    sources in order of size over weight, the capped ones are a prefix, so one running
    sum over the sources finds the level that the others share.
    """
    of = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    of = of.withColumn("weight", weight.cast("double"))
    by = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole)
    left = total - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    of = of.withColumn("level", left / F.sum("weight").over(after))
    of = of.withColumn("free", F.col("level") * F.col("weight") < most * F.col("source_size"))
    level = F.min(F.when(F.col("free"), F.struct((F.col("source_size") / F.col("weight")).alias("ratio"), "source", "level"))).over(whole)
    target = F.when(F.col("free"), level["level"] * F.col("weight")).otherwise(most * F.col("source_size"))
    return of.select("source", "source_size", target.cast("double").alias("target"))


def held_back(lengths) -> int:
    """Words left to the program: room for two texts of any length."""
    return max(PROGRAM, min(PROGRAM_LONG, 2 * max(lengths, default=0)))


def fitted(lengths: dict[int, int], budget: int) -> dict[int, int]:
    """How many of the documents of each length to take so that the sum is near the budget.

    Largest lengths first while more than ``held_back`` is left, then a subset-sum program
    with one piece for each power of two of a length's count.  Bit s of ``reach`` says
    that s can be reached; ``by`` lists the sums that each piece was the first to reach.  Of the sums up to
    twice the budget the nearest is taken, the smaller one in a tie.
    """
    take = dict.fromkeys(lengths, 0)
    hold = held_back(k for k, count in lengths.items() if count)
    for length in sorted(lengths, reverse=True):
        if budget > hold and length:
            take[length] = min(lengths[length], max(0, budget - hold) // length)
            budget -= take[length] * length
    if budget <= 0:
        return take
    # what is left is below the sum of hold and the shortest remaining length, or is all that remains
    budget = min(budget, sum(k * (count - take[k]) for k, count in lengths.items()))
    most, goal = 2 * budget, budget
    mask = (1 << (most + 1)) - 1
    reach, by = 1, []
    for length in sorted(k for k in lengths if 0 < k <= most):
        count, piece = lengths[length] - take[length], 1
        while count > 0 and piece * length <= most:
            n = min(piece, count)
            new = (reach << (n * length)) & ~reach & mask
            if new:
                by.append((length, n, new))
                reach |= new
            count, piece = count - n, piece * 2
        if reach >> goal & 1:
            break
    low = (reach & ((1 << (goal + 1)) - 1)).bit_length() - 1
    above = reach >> goal
    high = goal + (above & -above).bit_length() - 1 if above else None
    at = low if high is None or goal - low <= high - goal else high
    for length, n, new in reversed(by):
        if at and new >> at & 1:
            take[length] += n
            at -= n * length
    return take


def _quota(pdf: pd.DataFrame) -> pd.DataFrame:
    """(source, size, times, extra) of one source's histogram of lengths."""
    target, whole = pdf.target.iat[0], int(pdf.source_size.iat[0])
    pdf = pdf.sort_values("size", ascending=False, ignore_index=True)
    times = min(REPEATS, int(target // whole)) if whole else 0
    budget = round(target) - times * whole if times < REPEATS else 0
    extra, left, carry = [], {}, 0
    share = max(0, budget - held_back(pdf["size"])) / whole if whole else 0
    for size, count in zip(pdf["size"].tolist(), pdf["count"].tolist()):
        # in proportion, and what a length can't take as a whole goes to the next, shorter one
        carry += share * size * count
        n = min(count, int(carry // size)) if size else 0
        carry -= n * size
        extra.append(n)
        left[size] = count - n
    rest = budget - sum(s * n for s, n in zip(pdf["size"].tolist(), extra))
    more = fitted(left, rest)
    pdf["times"], pdf["extra"] = times, [n + more[s] for n, s in zip(extra, pdf["size"].tolist())]
    return pdf[["source", "size", "times", "extra"]]


def mixed(docs: DataFrame, seed: int = 1) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and source.

    ``taken`` counts repeats.  Null and empty texts have size 0 and take nothing.  The
    seeded choice depends on the id alone, so reruns agree; repeated rows are documents
    of their own, and which of them is taken makes no difference.
    """
    sizes = stored(sized(docs), "sizes")
    budget = stored(targets(sizes), "targets")
    counts = stored(sizes.groupBy("source", "size").count(), "lengths")
    same = F.col("l.source").eqNullSafe(F.col("r.source"))
    histogram = counts.alias("l").join(budget.alias("r"), same)
    histogram = histogram.select("l.source", "size", "count", "source_size", "target")
    quota = stored(
        histogram.groupBy("source").applyInPandas(_quota, "source string, size long, times long, extra long"), "quota"
    )
    quota = histogram.alias("l").join(
        quota.withColumnRenamed("size", "of").alias("r"), same & (F.col("size") == F.col("of"))
    ).select("l.source", "size", "count", "source_size", "target", "times", "extra")

    order = F.xxhash64(F.lit(seed), "doc_id")
    rows = sizes.alias("l").join(
        quota.withColumnRenamed("size", "of").alias("r"), same & (F.col("size") == F.col("of"))
    ).select("doc_id", "l.source", "size", "count", "source_size", "target", "times", "extra", order.alias("hash"))
    # a length's documents are ranked in groups by ranges of the hash, so that none is large
    groups = F.ceil(F.col("count") / GROUP)
    group = F.floor((F.shiftrightunsigned("hash", 16) * groups) / F.lit(float(1 << 48))).cast("long")
    rows = rows.withColumn("group", group)
    key = ["source", "size", "group"]
    some = rows.where("extra > 0 and extra < count")
    per = some.groupBy(*key).agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("source", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("earlier", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("hash", "doc_id"))
    ranked = some.withColumn("rank", rank).alias("l").join(
        per.alias("r"), same & (F.col("l.size") == F.col("r.size")) & (F.col("l.group") == F.col("r.group"))
    )
    chosen = (F.col("rank") + F.col("earlier") <= F.col("extra")).cast("int")
    columns = ["doc_id", "l.source", "l.size", "source_size", "target", "times"]
    out = ranked.select(*columns, chosen.alias("once")).unionByName(
        rows.where("not (extra > 0 and extra < count)").alias("l").select(*columns, (F.col("extra") > 0).cast("int").alias("once"))
    )
    return out.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * (F.col("times") + F.col("once"))).alias("taken"),
    )
