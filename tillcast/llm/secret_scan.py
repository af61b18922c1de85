"""Secret scan: fixed patterns, and strings that a primed zstandard coder finds novel.

A candidate is a long run of key characters that a sensitive word precedes.  What it costs
in its place is measured: the coder is primed with a dictionary trained on common identifiers,
and the marginal bytes are those of the text around the candidate with the candidate less
those of the text around alone.  Paths, names and placeholders repeat their surroundings
or the dictionary, or are spelled in letters that the dictionary finds likely; a key
costs about its own length.  A candidate that costs at least ``NOVEL`` bytes for each
of its characters is reported.

Rows are independent of each other: nothing is shuffled, and a task's work grows with
the bytes of its texts, as every candidate reads a window of fixed width.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import map_arrow, utf8

#: The base patterns, in their order, and the characters that a match needs.
BASE = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
        ),
        2,
        12,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),  # shorter runs would be dropped in any case
)
KINDS = (*(k for k, *_ in BASE), "novel")

LEAST = 16  # characters of a candidate
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{%d,}" % LEAST)
SENSITIVE = re.compile(
    r"passw|passwd|passphrase|secret|token|api.?key|access.?key|private.?key|credential|auth|bearer|signature", re.I | re.A
)
MIXED = re.compile(r"[0-9]|[a-z][^a-z]*[A-Z]|[A-Z][^A-Z]*[a-z]")
NAME = re.compile(r"[A-Za-z_]{0,32}[=.~:/-]+")  # the rest of a name and the signs behind it
REACH = 48  # characters before a candidate in which a sensitive word counts
AROUND = 128  # characters on each side that go before a candidate
NOVEL = 0.8  # marginal bytes for each character
#: Words that identifiers and placeholders are made of.
IDENTIFIERS = (
    "password passphrase passwd secret secret_key token access_token refresh_token api_key apikey access_key "
    "private_key public_key credential credentials authorization authentication bearer signature username "
    "user_name default example sample placeholder changeme change_me your_ insert redacted removed xxxxxxxxxxxxxxxx "
    "................ ================ ---------------- ________________ 0000000000000000 1234567890 0123456789 "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ config configuration settings environment variable "
    "localhost development production staging testing database connection session client server service provider "
    "manager handler factory controller request response header content application function return import export "
    "class public static private protected string integer boolean number object array value values index length "
    "https:// http:// www. .com/ .example.com .org/ .html .json .yaml .properties github.com/ amazonaws.com "
    "googleapis.com /usr/local/lib/ /home/ /var/lib/ /etc/ src/main/java/ org.apache. com.example. node_modules/ "
    "BEGIN END PUBLIC PRIVATE CERTIFICATE"
)


def identifier_dictionary(identifiers: str = IDENTIFIERS, size: int = 4096) -> bytes:
    """A zstandard dictionary, with its tables of literals, of identifiers joined in the usual ways."""
    rng = random.Random(1)
    words = [w.strip("_./:=-") for w in identifiers.split()]
    words = [w for w in words if len(w) > 2 and not w[0].isdigit()]
    samples = [rng.choice("_ ./-").join(rng.choices(words, k=6)).encode() for _ in range(2000)]
    return zstandard.train_dictionary(size, samples).as_bytes()


class Novelty:
    """Marginal bytes of a string behind a dictionary and the text around it."""

    def __init__(self, dictionary: bytes, level: int = 3):
        self.coder = zstandard.ZstdCompressor(
            level=level,
            dict_data=zstandard.ZstdCompressionDict(dictionary),
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )

    def marginal(self, text: str, before: str, after: str) -> int:
        around = (after + "\n" + before).encode("utf-8", "replace")
        return len(self.coder.compress(around + text.encode("utf-8", "replace"))) - len(self.coder.compress(around))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points, ordered."""
    found = []
    for kind, (_, pattern, group, least) in enumerate(BASE):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of key characters behind a sensitive word that touch none of the spans taken.

    Of ``name=value`` only the value is one, so a run is cut behind its sensitive words
    and the signs that follow them.  Letters of one case alone are a word and no key.
    """
    ends = sorted((s, e) for s, _, e in taken)
    k = reach = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while k < len(ends) and ends[k][0] < end:
            reach = max(reach, ends[k][1])
            k += 1
        if reach > start:
            continue
        named = list(SENSITIVE.finditer(text, max(0, start - REACH), end))
        if not named:
            continue
        for word in named:
            cut = NAME.match(text, word.end(), end)
            if word.start() >= start and cut:
                start = cut.end()
        if end - start >= LEAST and MIXED.search(text, start, end):
            yield start, end


def novel_spans(text: str, taken: list, novelty: Novelty, least: float = NOVEL) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the candidates that cost at least ``least`` bytes a character."""
    out = []
    for start, end in candidates(text, taken):
        cost = novelty.marginal(text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND])
        if cost >= least * (end - start):
            out.append((start, len(BASE), end))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scanned(docs: DataFrame, dictionary: bytes | None = None, least: float = NOVEL) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base, spans.

    ``base`` and ``spans`` list ``kind:start:end`` in code points, the end exclusive, by
    start and then by kind; ``spans`` holds the base ones and the novel ones.  Null and
    empty texts have none.  Whole texts are read, and a text that comes back has the
    same spans each time; a null id is kept.  Other columns are not read.  ``dictionary``
    primes the coder, by default that of :data:`IDENTIFIERS`.
    """
    primed = dictionary or identifier_dictionary()

    def rows(batch: pa.RecordBatch):
        novelty = Novelty(primed)
        base, spans, counts = [], [], []
        for raw in utf8(batch.column(1)):
            text = raw.decode("utf-8", "replace")
            fixed = base_spans(text)
            base.append(joined(fixed))
            spans.append(joined(sorted(fixed + novel_spans(text, fixed, novelty, least))))
            kinds = [k for _, k, _ in fixed]
            counts.append([kinds.count(k) for k in range(len(BASE))])
        n = {f"n_{kind}": [c[k] for c in counts] for k, (kind, *_) in enumerate(BASE)}
        yield {"doc_id": batch.column(0), **n, "base": base, "spans": spans}

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        rows,
        "doc_id long,n_assign long,n_access long,n_hex long,base string,spans string",
    )

