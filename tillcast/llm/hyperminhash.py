"""MinHash near-dedup with HyperMinHash registers (Yu and Weber, 2017).

A document's distinct two-word shingles are hashed to 64 bits.  The top bits
choose one of ``REGISTERS`` buckets; of the smallest hash in a bucket only the
count of leading zeros and the next ``MANTISSA`` bits are kept, 16 bits in all.
Empty buckets borrow a filled one by a fixed probe order (optimal densification),
so short documents have full sketches too.  Bands of registers give candidates;
the estimate, corrected for registers equal by chance, discards clear misses;
full shingle sets confirm what is left.

Links are only needed between classes (documents with the same shingle set), and
only until every component is joined: in each band group all members are first
compared with one leader after another, then all members that still are in different
components with each other, large groups in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import (
    components,
    distinct,
    map_arrow,
    pair_hash,
    stored,
    text_blocks,
    utf8,
    word_hashes,
)

BITS = 8  # 2 ** BITS buckets
REGISTERS = 1 << BITS
MANTISSA = 10
BAND = 6  # registers in a band
BANDS = REGISTERS // BAND
CHANCE = 0.169919487159739  # of equal registers from different minima, times 2 ** -MANTISSA
SIGMAS = 5.0
SMALL = 8  # members of a group whose pairs are joined
BLOCK = 512  # members compared in one task with as many others


def shingles(h: np.ndarray, width: int = 2) -> np.ndarray:
    """Hashes of the consecutive shingles; fewer words than the width are one shingle."""
    if 0 < len(h) < width:
        width = len(h)
    out = h[: max(0, len(h) - width + 1)]
    for k in range(1, width):
        out = pair_hash(out, h[k : len(h) - width + 1 + k])
    return out


def shingle_sets(texts: list[bytes], width: int = 2) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for low, high in text_blocks(texts):
        h, ends = word_hashes(texts[low:high])
        at = 0
        for end in ends:
            yield distinct(shingles(h[at:end], width))
            at = end


_PROBES = np.random.default_rng(20).integers(0, REGISTERS, (8 * REGISTERS, REGISTERS))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The 16-bit registers of a sorted set of hashes; the set must not be empty."""
    bucket = (shingles >> np.uint64(64 - BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rest = shingles[first] << np.uint64(BITS)
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    after = (rest << np.uint64(1)) << zeros.astype(np.uint64)
    out = np.zeros(REGISTERS, np.uint16)
    filled = np.zeros(REGISTERS, bool)
    at = bucket[first]
    out[at] = (zeros << MANTISSA).astype(np.uint16) | (after >> np.uint64(64 - MANTISSA)).astype(
        np.uint16
    )
    filled[at] = True
    empty = np.flatnonzero(~filled)
    for probe in (_PROBES[:32], _PROBES):
        if not len(empty):
            break
        hit = filled[probe[:, empty]]
        found = hit.any(0)
        out[empty[found]] = out[probe[hit.argmax(0)[found], empty[found]]]
        empty = empty[~found]
    out[empty] = out[at[0]]
    return out


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, without what collides by chance."""
    ratio = n_a / n_b
    chance = CHANCE * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return ((a == b).mean(1) - chance) / (1 - chance)


def sketch(docs: DataFrame, width: int = 2) -> DataFrame:
    """(doc_id, n, digest, regs): set size, identity of the set, registers (null if empty)."""

    def rows(batch: pa.RecordBatch):
        n, digest, regs = [], [], []
        for s in shingle_sets(utf8(batch.column(1)), width):
            n.append(len(s))
            digest.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
            regs.append(registers(s).tobytes() if len(s) else None)
        yield {"doc_id": batch.column(0), "n": n, "digest": digest, "regs": regs}

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        rows,
        "doc_id long, n long, digest binary, regs binary",
    )


def near_duplicates(
    docs: DataFrame, width: int = 2, similar: int = 80, leaders: int = 2
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * intersection >= similar * union of their sets.
    Null, empty and word-free texts have no shingles and link with nothing; rows with
    one doc_id are one node; a null id is returned with a null component and kept.

    ``leaders``: turns in which a group's members meet one leader, before all that is
    left is compared; more turns change the work, not the result.
    """
    sk = stored(sketch(docs, width), "sketch")
    classes = sk.where("digest is not null and doc_id is not null")
    classes = classes.groupBy("digest").agg(F.min("doc_id").alias("id"))
    reps = stored(
        sk.select(F.col("doc_id").alias("id"), "digest", "n", "regs")
        .join(classes, ["digest", "id"], "left_semi")
        .dropDuplicates(["digest", "id"])
        .drop("digest"),
        "classes",
    )
    groups = stored(_band_groups(reps), "bands")
    ids = groups.select("id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    texts = stored(texts.join(ids, "id", "left_semi"), "texts")

    tested = links = None
    node = groups.withColumn("component", F.col("id"))
    for turn in range(leaders + 1):
        node = _open(node)
        if turn == 0 and node.isEmpty():
            break
        pairs, blocks = (_led(node, turn), None) if turn < leaders else _rest(node, reps, texts, width, similar)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = _confirmed(pairs, reps, texts, width, similar)
        found = stored(found if blocks is None else found.unionByName(blocks), "links")
        links = found if links is None else links.unionByName(found)
        joined = stored(components(links), "components")
        tested = pairs if tested is None else tested.unionByName(pairs)
        node = groups.join(joined, "id", "left").select(
            "key", "id", F.coalesce("component_id", "id").alias("component")
        )
    if links is None:
        joined = classes.select("id", F.col("id").alias("component_id"))
    out = sk.join(classes, "digest", "left").join(joined, "id", "left")
    component = F.coalesce("component_id", "id", "doc_id")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _band_groups(reps: DataFrame) -> DataFrame:
    """(key, id) of the band keys that two or more classes share."""
    key = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(k, F.substring("regs", k * (2 * BAND) + 1, F.lit(2 * BAND))),
    )
    bands = reps.select("id", F.explode(key).alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    return bands.join(shared.select("key"), "key", "left_semi").distinct()


def _open(node: DataFrame) -> DataFrame:
    """The members of groups that still hold several components, with the groups' sizes."""
    of = node.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("rows"))
    return stored(node.join(of.where("x <> y").select("key", "rows"), "key"), "open")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _led(node: DataFrame, turn: int) -> DataFrame:
    """Candidates (a, b) of each member and its group's leader: no more pairs than rows.

    The leader is the smallest id first, then the smallest hash of the turn.
    """
    order = F.xxhash64(F.lit(turn), "key", "id") if turn else F.col("id")
    first = F.struct(order.alias("o"), F.col("id").alias("leader"), F.col("component").alias("own"))
    led = node.join(node.groupBy("key").agg(F.min(first).alias("l")), "key").where("component <> l.own")
    return _ordered(led.select(F.col("l.leader").alias("a"), F.col("id").alias("b")))


def _rest(
    node: DataFrame, reps: DataFrame, texts: DataFrame, width: int, similar: int
) -> tuple[DataFrame, DataFrame]:
    """What is left: candidates of small groups, and confirmed links of large ones.

    Groups of up to ``SMALL`` members are joined with themselves.  A larger group is cut
    into blocks; a task compares two blocks, confirms on full sets what is likely and not
    yet joined, and returns no more links than it has members.
    """
    small = node.where(F.col("rows") <= SMALL)
    other = small.select("key", F.col("id").alias("b"), F.col("component").alias("other"))
    pairs = small.withColumnRenamed("id", "a").join(other, "key").where("component < other").select("a", "b")

    large = node.where(F.col("rows") > SMALL).join(reps, "id").join(texts, "id")
    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    large = large.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    large = large.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))

    def compare(pdf):
        regs = np.frombuffer(b"".join(pdf.regs), np.uint16).reshape(-1, REGISTERS)
        ids, n, of, block = (pdf[c].to_numpy() for c in ("id", "n", "component", "block"))
        sets = list(shingle_sets([(t or "").encode() for t in pdf.text], width))
        left, right = np.flatnonzero(block == pdf.i.iat[0]), np.flatnonzero(block == pdf.j.iat[0])
        root = np.unique(of, return_inverse=True)[1]  # members of one component share a number
        out = []
        for k in left:
            mine = right[root[right] != root[k]]
            regs_k = np.broadcast_to(regs[k], (len(mine), REGISTERS))
            for m in mine[_may_reach(regs_k, regs[mine], np.full(len(mine), n[k]), n[mine], similar)]:
                if root[m] != root[k] and _similar(sets[k], sets[m], similar):
                    out.append((ids[k], ids[m]))
                    root[root == root[m]] = root[k]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    cells = large.select("key", "i", "j", "block", "id", "component", "n", "regs", "text")
    return _ordered(pairs), cells.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long")


def _similar(x: np.ndarray, y: np.ndarray, similar: int) -> bool:
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= similar * (len(x) + len(y) - common)


def _may_reach(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similar: int) -> np.ndarray:
    """Whether sizes and registers leave it open that the sets are similar."""
    spread = np.sqrt(0.16 / np.minimum(np.minimum(n_a, n_b), REGISTERS))
    sizes = 100 * np.minimum(n_a, n_b) >= similar * np.maximum(n_a, n_b)
    return sizes & (estimate(a, b, n_a, n_b) >= similar / 100 - SIGMAS * spread)


def _confirmed(
    pairs: DataFrame, reps: DataFrame, texts: DataFrame, width: int, similar: int
) -> DataFrame:
    """The pairs whose estimate may reach the similarity and whose full sets do."""

    def likely(batch: pa.RecordBatch):
        n_a, n_b = (batch.column(k).to_numpy() for k in (2, 3))
        a, b = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            for k in (4, 5)
        )
        keep = pa.array(_may_reach(a, b, n_a, n_b, similar), pa.bool_())
        yield {"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep)}

    def sure(batch: pa.RecordBatch):
        left = shingle_sets(utf8(batch.column(2)), width)
        right = shingle_sets(utf8(batch.column(3)), width)
        keep = [_similar(x, y, similar) for x, y in zip(left, right, strict=True)]
        keep = pa.array(keep, pa.bool_())
        yield {"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep)}

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*(F.col(c).alias(name if c == "id" else f"{c}_{name}") for c in df.columns))

    both = pairs.join(side(reps, "a"), "a").join(side(reps, "b"), "b")
    both = both.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similar)
    close = map_arrow(both.select("a", "b", "n_a", "n_b", "regs_a", "regs_b"), likely, "a long, b long")
    close = stored(close, "close")
    both = close.join(side(texts, "a"), "a").join(side(texts, "b"), "b")
    return map_arrow(both.select("a", "b", "text_a", "text_b"), sure, "a long, b long").distinct()
