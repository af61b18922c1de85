"""Packing along a space-filling curve.

Every document's token counts are hashed by random directions to ``DIMENSIONS``
numbers, the numbers become a position on a Hilbert curve (Skilling, 2004), rows
are range-sorted by that position, and neighbours along the curve are packed
together.  Each range is packed on its own: its sequences are full, and what
is left at its end becomes sequences whose lengths are powers of two.

Tokens are made once and written; texts with the same position are ordered by a
hash of the id, so that a position shared by a third of all rows still splits.
"""

from __future__ import annotations

import re
import sys
import zlib
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import map_arrow, partitions_for, stored, utf8

LENGTH = 4096
END = 2
DIMENSIONS = 4
BITS = 8  # of each dimension
RANGE_TOKENS = 8_000_000
CACHED = 400_000  # pieces whose ids a task remembers
CHUNK = 64  # bytes; longer pieces are not remembered
#: The vocabulary's contractions and special tokens.
PIECE = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|[a-zA-Z\x80-\xff]+|[0-9]|[^\sa-zA-Z0-9\x80-\xff]+")
SPECIAL = re.compile(rb"<\|(?:startoftext|endoftext)\|>", re.IGNORECASE)
#: Characters for the bytes from 0x80 on that a byte-level vocabulary does not spell as themselves.
SPELT = {b: 0x100 + 33 + k for k, b in enumerate([*range(0x7F, 0xA1), 0xAD])}


class _Known(dict):
    """Ids of pieces; those of a piece looked up for the first time are made then."""

    def __init__(self, tokens: Tokens):
        super().__init__()
        self.tokens = tokens

    def __missing__(self, piece: bytes) -> bytes | None:
        ids = self.tokens._learn(piece)
        if len(piece) <= CHUNK:
            self[piece] = ids
        return ids


class Tokens:
    """Ids of a text, put together from the ids of its pieces.

    ``PIECE`` cuts bytes as the vocabulary's pre-tokenizer cuts characters, as long as
    what is not ASCII is letters; it drops white space.  Other texts, and those that name
    a special token, are encoded whole.  Ids are cached as two-byte little-endian.
    Unknown words of Latin-1 letters, which the vocabulary's normalizer only lower-cases,
    go straight to its merges, spelt in its characters for bytes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True
        self.known = _Known(self)  # None: not a piece by itself

    def of(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > CACHED:
            self.known.clear()
        out, ids_of = [], self.known.__getitem__
        for text in texts:
            pieces = [] if SPECIAL.search(text) else PIECE.findall(text.lower())
            try:
                ids = b"".join(map(ids_of, pieces))
            except TypeError:  # a piece that is none by itself
                ids = None
            out.append(ids or self._encoded(text.decode("utf-8", "replace")))
        return out

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _learn(self, piece: bytes) -> bytes | None:
        word = piece.decode("utf-8", "replace")
        if word.isalpha():
            if word.isascii():
                return _two_bytes(self.merges.tokenize(word))
            if max(word) <= "\xff":
                spelt = word.lower().encode().decode("latin-1").translate(SPELT)
                return _two_bytes(self.merges.tokenize(spelt))
            ids = self._encoded(word)  # two words if lower-casing made a mark of a letter
            return ids if self.ends[np.frombuffer(ids, "<u2")].sum() == 1 else None
        return self._encoded(word) if word.isascii() else None


def _two_bytes(tokens: list) -> bytes:
    return b"".join([t.id.to_bytes(2, "little") for t in tokens])


def kept_tokens(path: str) -> Tokens:
    """The vocabulary's :class:`Tokens` of this process.

    A Python worker runs many tasks, each with functions of its own; a module of the
    process keeps what the tasks before have learned.
    """
    kept = sys.modules.setdefault("_tillcast_tokens", ModuleType("_tillcast_tokens")).__dict__
    if path not in kept:
        kept[path] = Tokens(path)
    return kept[path]


def directions(size: int = 1 << 16, seed: int = 11) -> np.ndarray:
    """A random direction for each token id, one row each."""
    return np.random.default_rng(seed).standard_normal((size, DIMENSIONS)).astype(np.float32)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, doc_tokens, p0 ...): ids as two-byte integers with the end id, and the projection."""
    names = [f"p{k}" for k in range(DIMENSIONS)]

    def rows(batch: pa.RecordBatch):
        if not state:
            state.update(tokens=kept_tokens(path), directions=directions())
        tokens, out = state["tokens"], state["directions"]
        for low in range(0, batch.num_rows, 256):
            ids = [x + b"\x02\x00" for x in tokens.of(utf8(batch.column(1).slice(low, 256)))]
            sizes = np.array([len(x) // 2 for x in ids])
            every = np.frombuffer(b"".join(ids), "<u2")
            total = np.add.reduceat(out[every], np.r_[0, np.cumsum(sizes)[:-1]], axis=0)
            total = total / np.sqrt(sizes)[:, None]
            yield {
                "doc_id": batch.column(0).slice(low, len(ids)), "ids": ids, "doc_tokens": sizes,
                **{n: total[:, k].astype(float) for k, n in enumerate(names)},
            }

    state: dict = {}
    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        rows,
        "doc_id long, ids binary, doc_tokens long, " + ", ".join(f"{n} double" for n in names),
    )


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of integer points, one a row, on a Hilbert curve of the given order."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for shift in range(bits - 1, 0, -1):  # undo the turns, from the largest cube down
        low = (1 << shift) - 1
        for k in range(n):
            up = (x[:, k] >> shift & 1).astype(bool)
            swap = np.where(up, 0, (x[:, 0] ^ x[:, k]) & low)
            x[:, 0] ^= np.where(up, low, swap)
            x[:, k] ^= swap if k else 0
    for k in range(1, n):
        x[:, k] ^= x[:, k - 1]
    turn = np.zeros(len(x), np.int64)
    for shift in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, n - 1] >> shift & 1, (1 << shift) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for shift in range(bits - 1, -1, -1):
        for k in range(n):
            key = key << 1 | (x[:, k] >> shift & 1)
    return key


def packed(
    docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Null and empty texts have the end id alone.  Repeated rows and rows without an id
    are documents like any other.  ``sequence_id`` is the range's number and a count.
    """
    tokens = stored(tokenized(docs, path), "tokens")
    names = [f"p{k}" for k in range(DIMENSIONS)]
    stats = tokens.agg(
        F.sum("doc_tokens"), *(f(n) for n in names for f in (F.avg, F.stddev_pop))
    ).first()
    total, middle, spread = stats[0] or 0, stats[1::2], stats[2::2]

    def keys(batch: pa.RecordBatch):
        points = np.stack([batch.column(2 + k).to_numpy() for k in range(DIMENSIONS)], 1)
        z = (points - np.array(middle, float)) / np.maximum(np.array(spread, float), 1e-9)
        cells = np.clip(((z + 3) / 6 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
        yield {"doc_id": batch.column(0), "ids": batch.column(1), "curve": hilbert_key(cells)}

    placed = map_arrow(tokens.select("doc_id", "ids", *names), keys, "doc_id long, ids binary, curve long")
    order = ["curve", F.xxhash64("doc_id"), "doc_id", F.crc32("ids")]
    ranges = partitions_for(docs.sparkSession, total, RANGE_TOKENS)
    placed = placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return _cut(placed.select("doc_id", "ids"), length, with_ids)


def _cut(placed: DataFrame, length: int, with_ids: bool) -> DataFrame:
    """Pieces of each partition's documents in order, in sequences without padding."""

    def run(batches):
        number, room_used = TaskContext.get().partitionId() << 32, 0
        last: list = []  # pieces of the open sequence
        for batch in batches:
            done = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(raw, "<u2")
                at = 0
                while at < len(ids):
                    take = min(length - room_used, len(ids) - at)
                    last.append((doc, at, ids[at : at + take], len(ids), number, room_used))
                    at += take
                    room_used += take
                    if room_used == length:
                        done += last
                        last, room_used, number = [], 0, number + 1
            yield _pieces(done)
        yield _pieces(_powers(last, room_used, number))

    out = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
        + [("ids", pa.list_(pa.int32()))]
    )

    def _pieces(done: list) -> pa.RecordBatch:
        cols = list(zip(*done)) or [[]] * 6
        data = [x.astype("<u4") for x in cols[2]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(c, type=f.type)
                for c, f in zip(
                    (cols[0], cols[1], [len(x) for x in data], [zlib.crc32(x.tobytes()) for x in data], cols[3], cols[4], cols[5], data if with_ids else [None] * len(data)),
                    out,
                )
            ],
            schema=out,
        )

    return placed.mapInArrow(
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>",
    )


def _powers(pieces: list, total: int, number: int) -> list:
    """The pieces of a short sequence, cut into sequences whose lengths are powers of two."""
    out, sizes = [], [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]
    used = 0
    for doc, at, ids, whole, _, _ in pieces:
        while len(ids):
            take = min(sizes[0] - used, len(ids))
            out.append((doc, at, ids[:take], whole, number, used))
            ids, at, used = ids[take:], at + take, used + take
            if used == sizes[0]:
                sizes, used, number = sizes[1:], 0, number + 1
    return out
