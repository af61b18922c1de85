"""LM scoring by deleted interpolation (Jelinek and Mercer, 1980).

P(w | v) = l2(b) f(w | v) + l1(b) f(w) + l0(b) / (V + 1)

``f`` are maximum-likelihood estimates from the training texts, V their distinct
tokens, and b is the bucket of v's frequency, one for each power of two.  The
weights come from expectation-maximisation: counts of one part of the training
texts against the tokens of the deleted part, by a histogram of both estimates with
``GRID`` cells for each doubling.  After that, counts use both parts.

Texts are cut into blocks of about ``TOKENS`` tokens.  A block sends each distinct
n-gram once, with its counts, to the bucket of the n-gram's hash, and gets the
counts of the whole corpus back in the same order.  Frequent words therefore cost
one entry for each block, and nothing that grows with the corpus is broadcast or
collected: the driver sees totals, a histogram of bounded size, and the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import (
    held_out,
    map_arrow,
    pair_hash,
    partitions_for,
    stored,
    text_blocks,
    utf8,
    word_hashes,
)

TOKENS = 1 << 20
SLICE = 2048  # texts held as Python bytes at a time
KEYS = 1 << 20  # distinct n-grams for each bucket, about
DIRECT = 256  # buckets that a block sends to itself
END = np.uint64(0xE17D0F7E87000001)
START = np.uint64(0x57A27000000000F1)
BUCKETS = 40
GRID = 4  # histogram cells for each doubling of a ratio
SPAN = 256  # cells on each axis; 0 stands for an estimate of zero
ROUNDS = 60


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time: a block's arrays are large, and a batch holds many."""
    for k in range(batch.num_rows):
        yield {n: c[k].as_py() for n, c in zip(batch.schema.names, batch.columns)}


def planes(x: np.ndarray) -> bytes:
    """Integers as compressed byte planes: high bytes are nearly all zero."""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def from_planes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    a = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(a.T).view(kind).ravel()


def blocks(docs: DataFrame, holdout: int, deleted: int, modulus: int) -> DataFrame:
    """(block, ids, part, ends, vocabulary, tokens): texts as indices into a block's own words.

    ``part``: 0 held out, 1 counted, 2 the deleted part.
    """

    def rows(batch: pa.RecordBatch):
        for low in range(0, batch.num_rows, SLICE):
            yield from cut(batch.slice(low, SLICE))

    def cut(batch: pa.RecordBatch):
        ids, out, known = (batch.column(k) for k in range(3))
        texts = utf8(batch.column(3))
        part = np.where(out.to_numpy(False).astype(bool), 0, np.where(known.to_numpy(False).astype(bool), 2, 1))
        part = part.astype(np.uint8)
        null = np.array([not x.is_valid for x in ids], bool)
        number = ids.fill_null(0).to_numpy().astype(np.int64)
        for low, high in text_blocks(texts, TOKENS * 6):
            h, ends = _hashed(texts[low:high])
            h = np.insert(h, ends, END)
            words, index, times = np.unique(h, return_inverse=True, return_counts=True)
            rank = np.argsort(-times, kind="stable")  # frequent words get small numbers
            place = np.empty(len(rank), np.uint32)
            place[rank] = np.arange(len(rank), dtype=np.uint32)
            yield {
                "block": [_block_id()],
                "ids": [number[low:high].tobytes()],
                "nulls": [null[low:high].tobytes()],
                "part": [part[low:high].tobytes()],
                "ends": [(ends + np.arange(1, len(ends) + 1)).astype(np.int64).tobytes()],
                "words": [words[rank].tobytes()],
                "tokens": [planes(place[index])],
            }

    counter = [0]

    def _block_id() -> int:
        counter[0] += 1
        return (TaskContext.get().partitionId() << 32) + counter[0]

    given = docs.select(
        F.col("doc_id").cast("long"),
        held_out("doc_id", modulus, holdout).alias("out"),
        held_out("doc_id", modulus, deleted).alias("deleted"),
        F.col("text").cast("string"),
    )
    return map_arrow(
        given, rows, "block long, ids binary, nulls binary, part binary, ends binary, words binary, tokens binary"
    )


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and ends of a block, a small range of texts at a time."""
    hashes, ends, before = [], [], 0
    for low, high in text_blocks(texts):
        h, e = word_hashes(texts[low:high])
        hashes.append(h)
        ends.append(e + before)
        before += len(h)
    return np.concatenate(hashes), np.concatenate(ends)


class Block:
    """One block in memory: per token its word, its bigram's place, and its document."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.ends = np.frombuffer(row["ends"], np.int64)
        words = np.frombuffer(row["words"], np.uint64)
        place = from_planes(row["tokens"], np.uint32)
        h = words[place]
        sizes = np.diff(self.ends, prepend=0)
        self.part = np.repeat(np.frombuffer(row["part"], np.uint8), sizes)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.first = self.ends - sizes
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[self.first] = START
        self.grams = []  # for each order: sorted keys, and each token's place among them
        order = np.argsort(words, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.grams.append((words[order], back[place]))
        self.grams.append(np.unique(pair_hash(before, h), return_inverse=True))

    def counts(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each key in the counted part and in the deleted part."""
        keys, at = self.grams[order]
        return tuple(
            np.bincount(at[self.part == p], minlength=len(keys)).astype(np.uint32) for p in (1, 2)
        )


def _cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, a range of hashes, begins and ends among sorted keys."""
    step = (1 << 64) // buckets + 1
    bounds = np.array([min(step * k, (1 << 64) - 1) for k in range(1, buckets)], np.uint64)
    return np.r_[0, np.searchsorted(keys, bounds), len(keys)]


def _sent(buckets: int):
    def rows(batch: pa.RecordBatch):
        for row in _rows(batch):
            b = Block(row)
            for order in (0, 1):
                keys, (one, two) = b.grams[order][0], b.counts(order)
                cut = _cut(keys, buckets)
                parts = [slice(x, y) for x, y in zip(cut[:-1], cut[1:])]
                yield {
                    "block": [row["block"]] * buckets,
                    "order": [order] * buckets,
                    "bucket": list(range(buckets)),
                    "keys": [planes(np.diff(keys[p], prepend=np.uint64(0))) for p in parts],
                    "one": [planes(one[p]) for p in parts],
                    "two": [planes(two[p]) for p in parts],
                }

    return rows


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of one bucket and order, returned to each block in its own order."""
    pdf = pdf.sort_values("block", ignore_index=True)
    keys = [np.cumsum(from_planes(x, np.uint64), dtype=np.uint64) for x in pdf["keys"]]
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = [
        np.bincount(at, np.concatenate([from_planes(x, np.uint32) for x in pdf[c]]), len(every)).astype(np.uint64)
        for c in ("one", "two")
    ]
    end = np.cumsum([len(k) for k in keys])
    out = pdf[["block", "order", "bucket"]].copy()
    for c, total in zip(("one", "two"), sums):
        out[c] = [planes(total[at[e - len(k) : e]]) for k, e in zip(keys, end)]
    out["known"] = 0
    out.loc[0, "known"] = int((sums[0] + sums[1] > 0).sum())
    return out


def _merged(ranges: int):
    """The n-grams of a group of blocks in one coarse range, summed and cut into fine ranges."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(from_planes(x, np.uint64), dtype=np.uint64) for x in pdf["keys"]]
        every, at = np.unique(np.concatenate(keys), return_inverse=True)
        one, two = (
            np.bincount(at, np.concatenate([from_planes(x, np.uint32) for x in pdf[c]]), len(every)).astype(np.uint32)
            for c in ("one", "two")
        )
        cut = _cut(every, ranges)
        parts = [(k, slice(x, y)) for k, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
        return pd.DataFrame(
            {
                "block": [pdf["sender"].iat[0]] * len(parts),
                "order": [pdf["order"].iat[0]] * len(parts),
                "bucket": [k for k, _ in parts],
                "keys": [planes(np.diff(every[p], prepend=np.uint64(0))) for _, p in parts],
                "one": [planes(one[p]) for _, p in parts],
                "two": [planes(two[p]) for _, p in parts],
            }
        )

    return run


def _returned(sent: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
    """The corpus counts of a group and coarse range, handed to each of its blocks in its own order."""
    keys = [np.cumsum(from_planes(x, np.uint64), dtype=np.uint64) for x in sent["keys"]]
    every = np.unique(np.concatenate(keys))
    got = got.sort_values("bucket")
    out = sent[["block", "order", "bucket"]].copy()
    for c in ("one", "two"):
        total = np.concatenate([from_planes(x, np.uint64) for x in got[c]] or [np.empty(0, np.uint64)])
        out[c] = [planes(total[np.searchsorted(every, k)]) for k in keys]
    return out


def corpus_counts(texts: DataFrame, buckets: int) -> tuple[DataFrame, int]:
    """(block, order, bucket, one, two) of every block's n-grams over the corpus, and V.

    Up to ``DIRECT`` buckets a block sends each of them a row.  Beyond, rows would grow with
    the square of the corpus, so there are two hops: a block sends to about the square root
    of so many coarse ranges; there as many blocks are summed together and sent on to fine
    ranges, and the answers come back the same way.
    """
    columns = "block long, order int, bucket int, keys binary, one binary, two binary"
    found = "block long, order int, bucket int, one binary, two binary"
    if buckets <= DIRECT:
        sent = map_arrow(texts, _sent(buckets), columns)
        counts = sent.groupBy("order", "bucket").applyInPandas(_summed, f"{found}, known long")
        counts = stored(counts, "counts")
        return counts, counts.where(F.col("order") == 0).agg(F.sum("known")).first()[0] or 0
    coarse = int(np.ceil(np.sqrt(buckets)))
    groups = max(1, -(-texts.count() // coarse))
    sender = F.pmod(F.xxhash64("block"), F.lit(groups)) * coarse + F.col("bucket")
    sent = stored(map_arrow(texts, _sent(coarse), columns).withColumn("sender", sender), "sent")
    fine = sent.groupBy("order", "sender").applyInPandas(_merged(coarse * coarse), columns)
    summed = fine.groupBy("order", "bucket").applyInPandas(_summed, f"{found}, known long")
    summed = stored(summed.withColumnRenamed("block", "sender"), "summed")
    counts = sent.groupBy("order", "sender").cogroup(summed.groupBy("order", "sender"))
    counts = stored(counts.applyInPandas(_returned, found), "counts")
    return counts, summed.where(F.col("order") == 0).agg(F.sum("known")).first()[0] or 0


def _joined(row: dict, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Corpus counts of the block's keys, counted and deleted part."""
    got = sorted((x for x in row["counts"] if x["order"] == order), key=lambda x: x["bucket"])
    return tuple(
        np.concatenate([from_planes(x[c], np.uint64) for x in got]).astype(np.float64) for c in ("one", "two")
    )


def _context(b: Block, unigram: np.ndarray, texts: float) -> np.ndarray:
    """The frequency of each token's left neighbour; before a first token, that of texts."""
    c = unigram[b.grams[0][1]]
    out = np.empty_like(c)
    out[1:] = c[:-1]
    out[b.first] = texts
    return out


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a frequency of zero, else 1 + the whole part of its binary logarithm."""
    return np.minimum(np.frexp(context)[1], BUCKETS - 1)


def _cells(ratio: np.ndarray) -> np.ndarray:
    """Histogram cell of an estimate over the uniform one; 0 if it is zero."""
    with np.errstate(divide="ignore"):
        cell = np.rint(GRID * np.log2(ratio)) + 64
    return np.where(ratio > 0, np.clip(cell, 1, SPAN - 1), 0).astype(np.int64)


def _ratios() -> np.ndarray:
    out = 2.0 ** ((np.arange(SPAN) - 64) / GRID)
    out[0] = 0
    return out


def learned(cells: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Weights (uniform, unigram, bigram) of each bucket, by EM over the histogram.

    A bucket without deleted tokens takes the weights of all buckets together.
    """
    b, one, two = cells // (SPAN * SPAN), cells // SPAN % SPAN, cells % SPAN
    f = np.stack([np.ones(len(cells)), _ratios()[one], _ratios()[two]], 1)
    out = np.empty((BUCKETS, 3))
    whole = _em(f, times)
    for k in range(BUCKETS):
        mine = b == k
        out[k] = _em(f[mine], times[mine]) if mine.any() else whole
    out[0, 2] = 0  # nothing follows a context that was never seen
    return out / out.sum(1, keepdims=True)


def _em(f: np.ndarray, times: np.ndarray) -> np.ndarray:
    w = np.full(3, 1 / 3)
    for _ in range(ROUNDS if len(f) else 0):
        share = f * w
        share /= share.sum(1, keepdims=True)
        w = (share * times[:, None]).sum(0) + 0.01  # never exactly zero
        w /= w.sum()
    return w


def score(docs: DataFrame, holdout: int = 1, deleted: int = 2, modulus: int = 5) -> DataFrame:
    """One row per text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from texts whose crc32(doc_id as text) mod ``modulus`` is not ``holdout``; a
    null id belongs to the training part.  Null and empty texts have one token, the end.
    Repeated rows count as often as they occur.  Without training texts, every token has
    probability one under both models.
    """
    spark = docs.sparkSession
    texts = stored(blocks(docs, holdout, deleted, modulus), "blocks")

    def totals(batch: pa.RecordBatch):
        for row in _rows(batch):
            part = np.frombuffer(row["part"], np.uint8)
            sizes = np.diff(np.frombuffer(row["ends"], np.int64), prepend=0)
            yield {
                "tokens": [int(sizes.sum())],
                "n1": [int(sizes[part == 1].sum())], "n2": [int(sizes[part == 2].sum())],
                "d1": [int((part == 1).sum())], "d2": [int((part == 2).sum())],
            }

    sums = "tokens long, n1 long, n2 long, d1 long, d2 long"
    total = map_arrow(texts.select("part", "ends"), totals, sums)
    tokens, n1, n2, d1, d2 = (x or 0 for x in total.agg(*(F.sum(c) for c in total.columns)).first())
    buckets = partitions_for(spark, tokens, KEYS)
    counts, vocabulary = corpus_counts(texts, buckets)
    back = counts.groupBy("block").agg(
        F.collect_list(F.struct("order", "bucket", "one", "two")).alias("counts")
    )
    evidence = stored(texts.join(back, "block"), "evidence")

    def histogram(batch: pa.RecordBatch):
        for row in _rows(batch):
            b = Block(row)
            one, two = _joined(row, 0)[0], _joined(row, 1)[0]
            context = _context(b, one, d1)
            use = b.part == 2
            context, f1 = context[use], one[b.grams[0][1]][use] / max(n1, 1)
            f2 = two[b.grams[1][1]][use] / np.maximum(context, 1)
            v = vocabulary + 1
            cell = (bucket_of(context) * SPAN + _cells(f1 * v)) * SPAN + _cells(f2 * v)
            cell, times = np.unique(cell, return_counts=True)
            yield {"cell": cell, "times": times}

    cells = map_arrow(evidence, histogram, "cell long, times long").groupBy("cell").agg(F.sum("times").alias("times"))
    cells = cells.toPandas()
    weights = learned(cells.cell.to_numpy(np.int64), cells.times.to_numpy(np.float64))
    n = n1 + n2

    def scores(batch: pa.RecordBatch):
        for row in _rows(batch):
            b = Block(row)
            one, two = (sum(_joined(row, k)) for k in (0, 1))
            context = _context(b, one, d1 + d2)
            c = one[b.grams[0][1]]
            f1 = c / max(n, 1)
            f2 = two[b.grams[1][1]] / np.maximum(context, 1)
            w = weights[bucket_of(context)]
            if not n:
                w = np.tile([1.0, 0.0, 0.0], (len(c), 1))
            p = w[:, 0] / (vocabulary + 1) + w[:, 1] * f1 + w[:, 2] * f2
            base = np.log10((c + 0.5) / (n + 0.5 * (vocabulary + 1)))
            texts = len(b.ids)
            part = b.part[b.first]
            yield {
                "doc_id": pa.array(b.ids, mask=b.nulls),
                "held_out": part == 0,
                "n_tokens": np.bincount(b.doc, minlength=texts),
                "n_known": np.bincount(b.doc[c > 0], minlength=texts),
                "train_tokens": [n] * texts,
                "base_score": np.bincount(b.doc, base, texts),
                "score": np.bincount(b.doc, np.log10(p), texts),
            }

    return map_arrow(
        evidence,
        scores,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
