"""URL filter: rules first, then logistic regression on hashed character n-grams.

The n-grams are those of the host and, apart, of the path.  The model is trained
from a small table of labelled URLs, by default :data:`LABELLED`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import bounded, map_arrow, utf8
from tillcast.llm.logistic import fit_sparse

#: Fixed values of the contract: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Labelled URLs by hand: what a host or path looks like that is kept, and one that is not.
LABELLED = {
    "allow": (
        "https://www.daily-herald.org/en/2021/05/city-council", "https://news.riverside.net/de/artikel/881",
        "https://blog.maria-writes.com/fr/recettes/12", "https://docs.openlibrary.org/en/guide/install.html",
        "https://m.townradio.com/es/programas", "http://history.university.edu/courses/medieval",
        "https://www.gardenclub.org/en/roses/pruning", "https://forum.cyclists.net/en/topic/3391",
        "https://blog.astronomer.org/de/beobachtung/44", "http://www.museum-am-see.de/de/ausstellung/7",
        "https://recipes.homecook.com/en/soup/lentil", "https://wiki.mathematics.org/en/theorem/fermat",
        "https://library.cityofbridges.gov/en/hours", "https://www.weatherstation.net/fr/station/19",
        "http://m.birdwatch.org/en/species/212.html", "https://school.northlake.edu/es/clases/3",
        "https://blog.thingsmade.org/en/641", "https://www.hetherton.org/en/471", "http://therand.org/en/454",
        "https://tionlake.net/de/975", "https://www.withering-heights.com/en/chapter/2", "https://ring.anderson.org/en/98",
        "https://blog.northern.net/en/960", "https://m.rounders.com/en/25", "https://www.lyndale.org/es/87",
        "https://eriness.example.org/en/12", "https://blog.wharton.example.org/fr/30", "https://thesis.example.org/de/5",
        "https://www.health-advice.gov/en/vaccines", "https://pharmacy-school.edu/en/admissions",
        "https://farm-museum.org/en/visit", "https://www.pillow-fort.net/en/sewing", "https://card-games.org/en/rules/whist",
        "https://thorium.example.net/en/91", "http://blog.another.example.net/en/960", "https://m.therefore.example.net/en/25",
        "https://www.nations.example.net/de/1502.html", "https://bleriot.example.net/en/77/", "https://shipyard.example.net/de/3120",
        "https://rangers.example.org/es/978", "https://www.inland.example.org/en/328", "http://erlang.example.org/de/217",
        "https://blog.ondine.example.org/en/777", "https://m.station.example.org/fr/533", "https://wheat.example.net/en/18",
        "https://entire.example.net/de/874", "https://blog.hearth.example.net/en/33102", "https://www.anthem.example.org/en/618",
        "https://redwood.example.org/en/20455/", "https://author.example.net/en/47", "https://sheriff.example.org/de/65.html",
        "https://www.bank-history.org/en/1907", "https://lottery-of-birth.org/en/essay", "https://chess.club.org/en/openings",
    ),
    "block": (
        "https://cheap-pills-online.com/en/buy-now", "http://www.pills-cheap.net/de/order/123", "https://cheap-meds.org/en/450",
        "https://viagra-discount.biz/fr/commande", "https://www.cheap-pills-store.org/es/17", "https://spam-links.net/en/728",
        "http://link-farm.org/en/1", "https://spamfarm.info/en/99", "https://www.spam-farm-network.com/de/12",
        "https://casino-bonus.org/en/win", "https://www.free-casino-spins.net/es/gratis", "http://online-casino.biz/en/slots",
        "https://hot-xxx-cams.com/en/live", "https://xxx-videos.net/fr/1", "https://adult-dating-hookup.org/en/join",
        "https://payday-loans-fast.com/en/apply", "https://instant-loans.biz/en/cash", "http://cheap-replica-watches.org/en/rolex",
        "https://replica-handbags-outlet.net/de/sale", "https://buy-followers-cheap.com/en/likes",
        "https://crack-keygen-download.net/en/serial", "https://free-warez.org/en/download", "http://click-here-win-prize.info/en/claim",
        "https://www.seo-backlinks-cheap.biz/en/order", "https://cheap-essays-online.org/en/buy",
        "https://sports-bets-free.net/en/33", "https://www.best-bets.example.org/en/5", "http://free-bets-today.com/es/70",
        "https://casino-wins.example.net/de/61", "https://blog.win-casino.org/fr/812", "https://free-spins-casino.example.org/en/4",
        "https://www.spam-links.example.net/en/55", "https://blog.link-farm.example.org/de/7", "https://spamfarm.example.net/es/941",
        "https://cheap-meds.example.org/fr/230", "http://buy-pills.example.net/en/18", "https://m.free-prize.example.org/en/602",
    ),
}
GRAMS = (3, 4, 5)
COLUMNS = 1 << 16
FIT_MOST = 20_000  # labelled URLs the model is fitted on


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, host, path): both empty for null and where ``://`` is missing."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select("page_id", host.alias("host"), F.regexp_extract(url, pattern, 2).alias("path"))


def ruled(urls: DataFrame, rules: tuple = RULES) -> DataFrame:
    """The URLs with the longest rule that fits and its verdict, null if none does."""
    longest = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))
    fits = [
        ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p) for h, p, _ in longest
    ]
    pick = [[F.when(f, F.lit(v)) for f, v in zip(fits, vs)] for vs in ([h + p for h, p, _ in longest], [v for *_, v in longest])]
    return urls.withColumn("rule", F.coalesce(*pick[0], F.lit(None).cast("string"))).withColumn(
        "ruled", F.coalesce(*pick[1], F.lit(None).cast("string"))
    )


def features(hosts: list[bytes], paths: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the hashed n-grams; each row has length one."""
    rows, cols = [], []
    for part, texts in enumerate((hosts, paths)):
        data = np.frombuffer(b"".join(b"\x02" + t + b"\x03" for t in texts), np.uint8).astype(np.uint64)
        ends = np.cumsum([len(t) + 2 for t in texts])
        of = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        for n in GRAMS:
            if len(data) < n:
                continue
            h = np.full(len(data) - n + 1, 1 + part, np.uint64)
            for k in range(n):
                h = (h ^ data[k : len(data) - n + 1 + k]) * np.uint64(0x100000001B3)
            whole = of[: len(h)] == of[n - 1 :]
            rows.append(of[: len(h)][whole])
            cols.append(((h >> np.uint64(20)) % np.uint64(COLUMNS)).astype(np.int64)[whole])
    r = np.concatenate(rows) if rows else np.empty(0, np.int64)
    c = np.concatenate(cols) if cols else np.empty(0, np.int64)
    code = np.unique(r * COLUMNS + c)
    r, c = code // COLUMNS, code % COLUMNS
    return r, c, 1 / np.sqrt(np.bincount(r, minlength=len(hosts)))[r]


def trained(labelled: DataFrame, most: int = FIT_MOST) -> tuple[np.ndarray, float]:
    """Weights and bias from distinct (host, path, label), at most ``most`` of them."""
    rows = labelled.select("host", "path", "label").distinct()
    rows = bounded(rows, F.xxhash64(F.lit(5), "host", "path"), most, "host", "path", "label").collect()
    y = np.array([r.label == "block" for r in rows], float)
    if not len(y) or y.min() == y.max():
        return np.zeros(COLUMNS), 1.0 if len(y) and y[0] else -1.0
    r, c, v = features([x.host.encode() for x in rows], [x.path.encode() for x in rows])
    n = len(y)  # the bias is one more column
    w = fit_sparse(np.r_[r, np.arange(n)], np.r_[c, np.full(n, COLUMNS)], np.r_[v, np.ones(n)] * 0.7, y, COLUMNS + 1)
    return w[:COLUMNS] * 0.7, float(w[COLUMNS] * 0.7)


def labelled_urls(spark: SparkSession, urls: dict[str, tuple[str, ...]] = LABELLED) -> DataFrame:
    """(host, path, label) of URLs by label."""
    rows = [(url, label) for label, some in urls.items() for url in some]
    df = spark.createDataFrame(rows, "url string, page_id string")
    return parsed(df).withColumnRenamed("page_id", "label")


def judged(pages: DataFrame, rules: tuple = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (probability of block).

    A null URL has an empty host and path, no rule, and the model's verdict on nothing.
    Without labelled URLs of both verdicts the model gives the only one it knows, or allow.
    Repeated URLs get equal verdicts, very long ones are read whole, other columns are not read.
    ``labelled`` has host, path and label; at most ``FIT_MOST`` of its rows teach.
    """
    urls = ruled(parsed(pages), rules)
    if labelled is None:
        labelled = labelled_urls(pages.sparkSession)
    weights, bias = trained(labelled)

    def rows(batch: pa.RecordBatch):
        r, c, v = features(utf8(batch.column(1)), utf8(batch.column(2)))
        x = np.bincount(r, v * weights[c], batch.num_rows) + bias
        yield {
            "page_id": batch.column(0), "host": batch.column(1), "path": batch.column(2),
            "rule": batch.column(3), "ruled": batch.column(4), "score": 1 / (1 + np.exp(-x)),
        }

    out = map_arrow(
        urls.withColumn("page_id", F.col("page_id").cast("long")),
        rows,
        "page_id long, host string, path string, rule string, ruled string, score double",
    )
    model = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", model).alias("verdict"), "score")
