"""Hard negatives by a threshold join on integer inner products, after L2AP.

For each anchor its best rows of the same label are its positives; a positive opens a
window of scores, and the best rows of other labels inside it are its hard negatives.
Both are threshold joins (Anastasiu and Karypis, 2014): the rows of a block are indexed by
dimension, and a row's last dimensions, whose norm alone cannot reach the threshold, are
left out of the index.  Partial scores accumulate over the posting lists; a pair
goes on only while its partial score and the norms that remain reach the threshold,
and what is left is verified in whole numbers.  The threshold starts high and is lowered
until every window of an anchor is full, so most anchors never see the low ones.

Anchors and rows meet in cells, a block of anchors with a block of rows, a task each
(positives: of one label).  A cell returns at most the wanted number of rows for a window, and the
best of all cells are ranked behind a limit for each group, so no label, however common,
is one task, and nothing that grows with the tables is broadcast or collected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import map_arrow, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # percent of the positive's score
ANCHORS, ROWS = 16_384, 16_384  # of a cell
PAIRS = 1 << 21  # compared at once
GROUP = 8  # dimensions between two looks at the norms
STEPS = (0.9, 0.75, 0.6, 0.45, 0.3, 0.15, 0.0)  # thresholds, of the two norms' product
LARGEST = 1 << 24  # components from here on would not fit the scores


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, size, vec): whole components as bytes, of the rows that take part."""

    def rows(batch: pa.RecordBatch):
        out = []
        for x in batch.column(2).to_pylist():
            a = np.array([np.nan if c is None else c for c in x], np.float64) if x is not None else np.array([np.nan])
            good = np.isfinite(a).all() and (np.abs(a) < LARGEST / SCALE).all()
            out.append(np.floor(a * SCALE).astype(np.int32).tobytes() if good else None)
        yield {"vec_id": batch.column(0), "label": batch.column(1), "vec": out}

    df = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    )
    df = map_arrow(df, rows, "vec_id long,label long,vec binary").where(
        "vec_id is not null and label is not null and vec is not null"
    )
    return df.withColumn("size", F.octet_length("vec") / 4)


# -- in a task ------------------------------------------------------------------


class Index:
    """Posting lists by dimension over a block of rows, rebuilt for each lower threshold.

    Dimensions are ordered by their energy.  Of a row the index holds the shortest
    beginning behind which its norm is below the threshold; rows are sorted by that length, so
    the posting list of a dimension is the first so many rows.
    """

    def __init__(self, x: np.ndarray):
        energy = (x * x).sum(0)
        self.order = np.argsort(-energy, kind="stable")
        self.x = x[:, self.order]
        left = np.cumsum((self.x * self.x)[:, ::-1], 1)[:, ::-1]
        self.left = np.sqrt(np.concatenate([left, np.zeros((len(x), 1))], 1))  # norm from a dimension on
        self.norm = self.left[:, 0]

    def candidates(self, q: np.ndarray, share: np.ndarray, least: np.ndarray):
        """(anchor, row) whose score may reach ``least``, where ``share`` is that over the anchor's norm."""
        q = q[:, self.order]
        q_left = np.sqrt(np.concatenate([np.cumsum((q * q)[:, ::-1], 1)[:, ::-1], np.zeros((len(q), 1))], 1))
        low = share.min() if len(share) else 0.0
        # dimensions indexed: up to the last one from which the norm reaches the least share
        held = (self.left >= low * (1 - 1e-9)).sum(1) if low > 0 else np.full(len(self.x), self.x.shape[1])
        held = np.minimum(held, self.x.shape[1])
        rows = np.argsort(-held, kind="stable")
        rows = rows[: np.searchsorted(-held[rows], 0)] if low > 0 else rows
        lengths, x, left = held[rows], self.x[rows], self.left[rows]
        score = np.zeros((len(q), len(rows)))
        width = x.shape[1]
        for at in range(0, width, GROUP):
            list_end = int(np.searchsorted(-lengths, -at))  # rows with more than ``at`` dimensions indexed
            if not list_end:
                break
            upto = min(at + GROUP, width)
            # a row's beginning may end inside the group; what it adds beyond is exact as well
            score[:, :list_end] += q[:, at:upto] @ x[:list_end, at:upto].T
        seen = np.minimum(width, -(-lengths // GROUP) * GROUP)  # dimensions that the partial score covers
        room = q_left[:, seen] * left[np.arange(len(rows)), seen]
        slack = 1e-9 * q_left[:, :1] * left[:, 0] + 0.5
        a, b = np.nonzero(score + room + slack >= least[:, None])
        return a, rows[b]


def _best(q, q_ids, x, x_ids, low, high, fits, wanted):
    """For each anchor and window the best rows: (anchor, window, row, score).

    ``low`` and ``high`` are whole bounds, one column for each window; ``fits`` takes (anchors,
    rows) and says which pairs count at all.
    """
    index = Index(x.astype(np.float64))
    whole = x.astype(np.int64)
    top = index.norm.max(initial=0.0)
    tie = np.argsort(np.argsort(x_ids, kind="stable"), kind="stable")
    tile = max(1, PAIRS // max(1, len(x)))
    for start in range(0, len(q), tile):
        rows = np.arange(start, min(len(q), start + tile))
        qf, qi = q[rows].astype(np.float64), q[rows].astype(np.int64)
        norm = np.sqrt((qf * qf).sum(1))
        floor, ceil = low[rows].astype(np.float64), high[rows].astype(np.float64)
        some = low[rows] <= high[rows]
        bottom = np.where(some, floor, np.inf).min(1)
        start_at = np.where(some, ceil, -np.inf).max(1)
        reach = norm * top
        todo = np.arange(len(rows))[some.any(1) & (bottom <= reach * (1 + 1e-9) + 0.5)]
        for step in (*STEPS, None):
            if not len(todo):
                break
            least = np.maximum(bottom, step * np.minimum(reach, np.maximum(start_at, 0))) if step is not None else bottom
            least = least[todo]
            share = np.where(norm[todo] > 0, least / np.maximum(norm[todo], 1e-300), np.where(least > 0, np.inf, -np.inf))
            a, b = index.candidates(qf[todo], share, least)
            a = todo[a]
            keep = fits(rows[a], b)
            a, b = a[keep], b[keep]
            score = np.concatenate(
                [np.einsum("ij,ij->i", qi[a[k : k + 65536]], whole[b[k : k + 65536]]) for k in range(0, len(a), 65536)]
                or [np.empty(0, np.int64)]
            )
            best, full = [], np.ones(len(rows), bool)
            done_at = np.full(len(rows), np.inf)
            done_at[todo] = least
            for w in range(low.shape[1]):
                mine = (score >= np.maximum(low[rows[a], w], done_at[a])) & (score <= high[rows[a], w])
                aw, bw, sw = a[mine], b[mine], score[mine]
                order = np.lexsort((tie[bw], -sw, aw))
                aw, bw, sw = aw[order], bw[order], sw[order]
                rank = np.arange(len(aw)) - np.searchsorted(aw, aw)
                first = rank < wanted
                best.append((aw[first], np.full(first.sum(), w), bw[first], sw[first]))
                count = np.bincount(aw[first], minlength=len(rows))
                full &= (count >= wanted) | ~some[:, w] | (done_at <= floor[:, w])
            ready = np.zeros(len(rows), bool)
            ready[todo] = full[todo]
            for aw, w, bw, sw in best:
                mine = ready[aw]
                yield rows[aw[mine]], w[mine], bw[mine], sw[mine]
            todo = todo[~full[todo]]


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(pdf.vec), np.int32).reshape(len(pdf), -1)


def _cell(wanted: int, same: bool):
    """A cell's task: the best rows of each anchor and window."""
    span = np.iinfo(np.int64)

    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"anchor": [], "w": [], "row_id": [], "score": []}).astype("int64")
        if not len(anchors) or not len(rows):
            return empty
        q, x = _matrix(anchors), _matrix(rows)
        q_ids, x_ids = anchors.vec_id.to_numpy(), rows.vec_id.to_numpy()
        q_label, x_label = anchors.label.to_numpy(), rows.label.to_numpy()
        if same:
            low = np.full((len(q), 1), span.min)
            high = np.full((len(q), 1), span.max)
        else:
            most = max(map(len, anchors.scores))
            score = np.array([[*s, *[-1] * (most - len(s))] for s in anchors.scores], np.int64)
            low, high = -(-LEAST * score // 100), MOST * score // 100
            low[score < 0], high[score < 0] = 1, 0  # an empty window
        fits = (lambda a, b: q_ids[a] != x_ids[b]) if same else (lambda a, b: q_label[a] != x_label[b])
        out = list(_best(q, q_ids, x, x_ids, low, high, fits, wanted))
        if not out:
            return empty
        a, w, b, s = (np.concatenate(c) for c in zip(*out))
        return pd.DataFrame({"anchor": anchors.anchor.to_numpy()[a], "w": w, "row_id": x_ids[b], "score": s}).astype("int64")

    return run


# -- the operator -----------------------------------------------------------------


def blocked(df: DataFrame, other: DataFrame, by: list[str], size: int, other_size: int, mine: str, theirs: str) -> DataFrame:
    """The rows dealt to ``mine`` blocks by a hash, once for each block of the other side."""
    own = df.groupBy(*by).agg(F.ceil(F.count("*") / size).cast("int").alias("own"))
    far = other.groupBy(*by).agg(F.ceil(F.count("*") / other_size).cast("int").alias("far"))
    out = df.join(own.join(far, by), by)
    out = out.withColumn(mine, F.pmod(F.xxhash64("at"), F.col("own")).cast("int"))
    return out.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col("far") - 1))).drop("own", "far")


def joined(anchors: DataFrame, rows: DataFrame, wanted: int, same: bool) -> DataFrame:
    """(anchor, w, row_id, score, rank): the first ``wanted`` rows of each anchor's windows."""
    by = ["size", "label"] if same else ["size"]
    q = blocked(anchors, rows, by, ANCHORS, ROWS, "i", "j")
    x = blocked(rows, anchors, by, ROWS, ANCHORS, "j", "i")
    cell = [*by, "i", "j"]
    found = q.groupBy(*cell).cogroup(x.groupBy(*cell)).applyInPandas(
        _cell(wanted, same), "anchor long, w long, row_id long, score long"
    )
    order = Window.partitionBy("anchor", "w").orderBy(F.col("score").desc(), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def mined(vectors: DataFrame, anchors: int = 50, relabelled: int = 7, labels: int = 10) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, with a component that is null, not finite or
    of ``LARGEST / SCALE`` or more, take no part.  Anchors are rows whose id ``anchors`` divides;
    where ``relabelled`` divides the id, the label is the next one of ``labels``.  Scores
    come first, ties go by the smaller id.  Vectors of different lengths are not
    compared; all zero vectors score 0 with everything.  Rows that repeat an id are rows of
    their own, and none is another row to one with its id; an anchor that repeats exactly
    is one anchor.  Other columns are not read.  Without anchors or partners there are no rows.
    """
    known = quantised(vectors)
    moved = F.when(F.col("vec_id") % relabelled == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    known = known.withColumn("label", moved).withColumn("at", F.monotonically_increasing_id())
    known = stored(known, "vectors")  # ``at`` tells repeated rows apart
    asked = known.where(F.col("vec_id") % anchors == 0).withColumn("anchor", F.xxhash64("vec_id", "label", "vec"))
    asked = stored(asked.dropDuplicates(["anchor"]), "anchors")
    best = stored(joined(asked, known, POSITIVES, True).drop("w"), "positives")
    windows = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("all"))
    windows = asked.join(windows, "anchor").withColumn("scores", F.col("all.score")).drop("all")
    near = joined(stored(windows, "windows"), known, NEGATIVES, False)
    near = near.select(
        "anchor", (F.col("w") + 1).alias("p"), "rank", F.col("row_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    best = best.select("anchor", F.col("rank").alias("p"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = asked.select("anchor", F.col("vec_id").alias("anchor_id"))
    out = near.join(best, ["anchor", "p"]).join(ids, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
