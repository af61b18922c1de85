"""Quality classifier by Bradley-Terry ranking.

A text's strength is linear in its features; the log-odds that one text is preferred
to another is the difference of their strengths.  The weights minimise the logistic
loss on feature differences over pairs of a preferred and a rejected text.  The
threshold is the quantile of the training strengths at the share of rejected texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import bounded, held_out, map_arrow, text_blocks, utf8, word_hashes
from tillcast.llm.logistic import fit, sigmoid

FIT_MOST = 20_000  # labelled texts the pairs are drawn from
PAIRS = 100_000
CUT = 0.3  # score of a text at the threshold
NAMES = ("words", "length", "symbols", "marks", "upper", "digits", "variety", "runs", "top", "lines")


def _class(chars: str | bytes) -> np.ndarray:
    out = np.zeros(256)
    out[np.frombuffer(chars.encode() if isinstance(chars, str) else chars, np.uint8)] = 1
    return out


_SYMBOLS = _class("#*$%&|<>@^~_=+{}[]\\/")
_MARKS = _class("!?.,;:")
_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGITS = _class("0123456789")
_LETTERS = 1 - _class(bytes(range(9, 14)) + b" ")


def features(texts: list[bytes]) -> np.ndarray:
    """One row of numbers for each whole text; zeros for a text without words."""
    out = np.zeros((len(texts), len(NAMES)))
    for low, high in text_blocks(texts):
        part = texts[low:high]
        data = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        at = np.r_[0, np.cumsum([len(t) + 1 for t in part])[:-1]]
        chars = np.maximum(1, np.add.reduceat(_LETTERS[data], at))
        hashes, ends = word_hashes(part)
        sizes = np.diff(ends, prepend=0)
        words = np.maximum(1, sizes)
        x = out[low:high]
        x[:, 0] = np.log1p(sizes)
        x[:, 1] = chars / words
        x[:, 2] = np.add.reduceat(_SYMBOLS[data], at) / words
        for k, kind in ((3, _MARKS), (4, _UPPER), (5, _DIGITS)):
            x[:, k] = np.add.reduceat(kind[data], at) / chars
        for k, (end, size) in enumerate(zip(ends, sizes)):
            h = np.sort(hashes[end - size : end])
            if size > 1:
                edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True])
                x[k, 6] = np.log(len(edge) - 1) / np.log(size)
                x[k, 7] = (hashes[end - size + 1 : end] == hashes[end - size : end - 1]).mean()
                x[k, 8] = np.diff(edge).max() / size
            lines = [t for t in part[k].split(b"\n") if t.strip()]
            x[k, 9] = 1 - len(set(lines)) / len(lines) if lines else 0
        x[sizes == 0] = 0
    return out


def trained(x: np.ndarray, y: np.ndarray, seed: int = 3) -> dict:
    """Mean, spread, weights and threshold; no weights if the labels hold one class only."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return {"share": float(y.mean()) if len(y) else 0.5}
    middle, spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.clip((x - middle) / spread, -6, 6)
    draw = np.random.default_rng(seed)
    pairs = min(PAIRS, len(good) * len(bad))
    difference = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
    # every pair also in the other order, so that the loss has both outcomes
    w = fit(np.concatenate([difference, -difference]), np.repeat([1.0, 0.0], pairs))
    strength = np.sort(z @ w)
    cut = strength[len(bad) - 1 : len(bad) + 1].mean()
    return {"middle": middle, "spread": spread, "weights": w, "cut": float(cut)}


def scored(x: np.ndarray, model: dict) -> np.ndarray:
    if "weights" not in model:
        return np.full(len(x), model["share"])
    z = np.clip((x - model["middle"]) / model["spread"], -6, 6)
    return sigmoid(z @ model["weights"] - model["cut"] + np.log(CUT / (1 - CUT)))


def model(docs: DataFrame, labels: DataFrame, modulus: int = 5, holdout: int = 0) -> dict:
    """Fitted on rows whose crc32(doc_id as text) mod ``modulus`` is not ``holdout``.

    At most ``FIT_MOST`` labels, chosen by a hash of the id, are used and broadcast.
    """
    teach = labels.where("quality is not null and doc_id is not null").where(~held_out("doc_id", modulus, holdout))
    teach = teach.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    teach = bounded(teach, F.xxhash64(F.lit(8), "doc_id"), FIT_MOST, "doc_id", "quality")

    def rows(batch: pa.RecordBatch):
        yield {"x": list(features(utf8(batch.column(0)))), "quality": batch.column(1), "doc_id": batch.column(2)}

    known = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    taught = known.join(F.broadcast(teach), "doc_id").select("text", "quality", "doc_id")
    sample = map_arrow(taught, rows, "x array<double>, quality int, doc_id long").collect()
    sample = sorted((r.doc_id, r.quality, r.x) for r in sample)
    x = np.array([r[2] for r in sample]).reshape(-1, len(NAMES))
    return trained(x, np.array([r[1] for r in sample], float))


def judged(docs: DataFrame, labels: DataFrame, modulus: int = 5, holdout: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score >= CUT).

    Null labels and ids teach nothing.  Null and empty texts have features of zero.  Equal
    texts get equal scores; a document with several labels counts with each.
    """
    fitted = model(docs, labels, modulus, holdout)

    def rows(batch: pa.RecordBatch):
        yield {"doc_id": batch.column(0), "score": scored(features(utf8(batch.column(1))), fitted)}

    known = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = map_arrow(known, rows, "doc_id long, score double")
    return out.select(
        "doc_id",
        held_out("doc_id", modulus, holdout).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def preferred(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents at or above the threshold, with all their columns."""
    fitted = model(docs, labels)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            keep = scored(features(utf8(batch.column(at))), fitted) >= CUT
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
