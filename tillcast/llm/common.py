"""Words, hashes, stored tables and connected components shared by the operators.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``.  On the JVM
that is :data:`WORD`; in Python the same cut is ``bytes.split()``, which knows
ASCII white space only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import new_path

WORD = r"[^\x20\x09-\x0D]+"
MASK = (1 << 64) - 1


def held_out(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text has this remainder; a null id is not held out."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id)
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: cuts the lineage."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession, rows: int, per_partition: int) -> int:
    """Partitions in proportion to the rows, at least one for each core of the session."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_partition))


def bounded(df: DataFrame, key: Column, most: int, *ties: str) -> DataFrame:
    """The first ``most`` rows by a hash, then by ``ties``: every run takes the same.

    Rows with a hash above twice the share wanted are left out before they are ordered, so what the
    partitions send on together stays near twice ``most``, however many there are.
    """
    rows, key = df.count(), F.pmod(key, F.lit(1 << 32))
    near = df.where(key < int(min(1.0, 2 * most / max(1, rows)) * (1 << 32)))
    if rows > 2 * most and near.limit(most).count() < most:  # most rows share a hash
        near = df
    return near.orderBy(key, *ties).limit(most)


def map_arrow(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` for a function from one record batch to dicts of columns."""
    out = pa.schema(_arrow_fields(df.sparkSession, schema))

    def run(batches):
        for batch in batches:
            for columns in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in out], schema=out
                )

    return df.mapInArrow(run, schema)


def _arrow_fields(spark: SparkSession, schema: str) -> list[pa.Field]:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
        "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
        "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()),
    }
    return [pa.field(*(lambda n, k: (n, kinds[k]))(*p.split())) for p in schema.split(",")]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of an ordered pair of hashes."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + mix(right))


#: One random 64-bit value for each byte; A-Z share those of a-z, white space has none.
_BYTES = np.random.default_rng(64).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x5851F42D4C957F2D
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, at least n + 1 of them."""
    if 0 not in _POWERS or len(_POWERS[0][0]) < n:
        size = 1 << max(21, int(n).bit_length())
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            both.append(np.multiply.accumulate(out))
        _POWERS[0] = (both[0], both[1])
    return _POWERS[0]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z lower-cased, and the end of each text among them.

    A word's hash is a polynomial over random byte values modulo 2 ** 64, so all
    words come from one running sum over the bytes; ``mix`` spreads it at the end.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[data]
    power, inverse = _powers(len(data))
    total = np.cumsum(_BYTES[data] * power[: len(data)], dtype=np.uint64)
    word = ~space
    start = np.flatnonzero(word & np.r_[True, space[:-1]])
    end = np.flatnonzero(space & np.r_[False, word[:-1]])
    before = np.where(start > 0, total[start - 1], np.uint64(0))
    hashes = mix((total[end - 1] - before) * inverse[start])
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(start, text_ends)


def text_blocks(texts: list[bytes], most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about this many bytes; a longer text has its own."""
    at = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            yield at, k
            at, size = k, 0
        size += len(text)
    if at < len(texts):
        yield at, len(texts)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


# -- connected components -----------------------------------------------------


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component_id) of every id on an edge (a, b); the component is its smallest id.

    Large-star and small-star rounds (Kiveris et al., 2014) over written tables:
    every round is two grouped minima with joins on the id, nothing is gathered
    per component, and a hub's rows are split by the skew join.
    """
    e = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        e = stored(_small_star(_large_star(e)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    ids = e.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    return ids.unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component_id"))).distinct()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
