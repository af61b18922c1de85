"""Embedding near-dedup on a robust-pruned flat graph.

Identical vectors collapse to one node with a count.  Every node is dealt to its
``overlap`` nearest centroids (above ``CENTROIDS_MOST``, to the nearest of each shard's own
centroids, so that a shard stays near the same size); each shard builds adjacency lists from its nearest
neighbours by robust pruning (Subramanya et al., 2019) and long edges, and the lists
of a node are united over its shards; of a united list a shard's search uses the nodes it
holds, so no search leaves its shard and the overlap carries links between shards.  In each shard every node is a query: a greedy search
enters at the shard's medoid and at the node itself and is then expanded through
every vertex in range.  Cosines are exact, in double precision.

A pair that meets in several shards counts in the smallest of them, so only
counts and one root per node and shard leave a task, never the pairs.  A shard
above ``SHARD_MOST`` rows is cut into blocks by a hash, and each pair of blocks is
a task of its own; no row is dropped.  Recall is audited against brute force over
a bounded set of queries at every overlap.  The overlap is doubled until recall reaches
the target; if the widest does not, all pairs are compared.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import bounded, components, map_arrow, stored

SHARD = 1500  # nodes for each centroid
CENTROIDS_MOST = 1024  # of the first level; above it each shard has centroids of its own
SUB_FIT = 6000  # vectors of a shard that its own centroids are fitted on
LEAVES = 1 << 32  # room for the numbers of a shard's own shards
FIT_MOST = 20_000  # vectors that the centroids are fitted on
SHARD_MOST = 12_000
CANDIDATES = 48
DEGREE = 24
ALPHA = 1.2
RANDOM = 4  # random members of the shard beside the pruned neighbours
BEAM = 8
PAIRS = 1 << 20  # of queries and nodes that a task has marks for at once
SLICE = 1 << 15  # pairs whose vectors or shards are read at once
DENSE = 0.25  # of the shard
SLACK = 0.1  # vertices this far below the range are still expanded
AUDIT = 200  # queries of each kind: no, few, many links found
FEW = 10  # links
RECALL = 0.95
NO_SHARD = np.iinfo(np.int64).max
OVERLAP_MOST = 32


def nodes(vectors: DataFrame) -> DataFrame:
    """(vec_id, digest, vec): unit vectors of doubles as bytes; null if it can link with nothing."""

    def rows(batch: pa.RecordBatch):
        digest, vec = [], []
        for x in batch.column(1).to_pylist():
            a = np.array([np.nan if c is None else c for c in x or ()], np.float64)
            # scaled first, so that neither huge nor tiny components lose the norm
            a = a / np.abs(a).max() if len(a) and np.isfinite(a).all() and a.any() else a[:0]
            unit = (a / np.sqrt((a * a).sum())).tobytes() if len(a) else None
            digest.append(unit and xxhash.xxh128_digest(unit))
            vec.append(unit)
        yield {"vec_id": batch.column(0), "digest": digest, "vec": vec}

    return map_arrow(
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")),
        rows,
        "vec_id long, digest binary, vec binary",
    )


def centroids(reps: DataFrame, count: int, seed: int = 7) -> dict[int, np.ndarray]:
    """Unit centroids for each vector length, by spherical k-means on a bounded sample."""
    sample = bounded(reps, F.xxhash64(F.lit(seed), "id"), FIT_MOST, "id").select("vec").collect()
    out = {}
    for size in {len(r.vec) for r in sample}:
        x = np.stack([np.frombuffer(r.vec) for r in sample if len(r.vec) == size])
        k = int(min(max(1, count * len(x) // len(sample)), max(1, len(x) // 4)))
        out[size] = fitted_to(x, k, seed)
    return out


def fitted_to(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` unit centroids by spherical k-means."""
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(8):
        near = np.concatenate([(x[low : low + 2048] @ c.T).argmax(1) for low in range(0, len(x), 2048)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, total / np.maximum(norm, 1e-9), c)
    return c


def dealt(reps: DataFrame, fitted: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """(shard, shards, id, copies, vec): each node in the shards of its nearest centroids."""
    first, at = {}, 0
    for size, c in sorted(fitted.items()):
        first[size], at = at, at + len(c)

    def rows(batch: pa.RecordBatch):
        shards = []
        for raw in batch.column(2).to_pylist():
            if len(raw) in fitted:
                c = fitted[len(raw)]
                near = np.argsort(-(c @ np.frombuffer(raw)), kind="stable")[:overlap]
                shards.append(sorted((near + first[len(raw)]).tolist()))
            else:  # a length that the sample lacks has a shard of its own
                shards.append([-len(raw)])
        yield {"id": batch.column(0), "copies": batch.column(1), "vec": batch.column(2), "shards": shards}

    out = map_arrow(reps.select("id", "copies", "vec"), rows, "id long, copies long, vec binary, shards array<long>")
    return out.withColumn("shard", F.explode("shards"))


def refined(members: DataFrame, wide: int, seed: int = 7) -> DataFrame:
    """The members dealt once more, inside each shard, to the ``wide`` nearest of its own centroids.

    A shard has a centroid for every ``SHARD`` of its nodes, fitted in a task of its own on a
    bounded sample by hash.  The members meet them in blocks of bounded size, so neither
    the centroids of all shards nor a whole shard are ever in one place.
    """
    sizes = members.groupBy("shard").agg(F.count("*").alias("n"))
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "id"), "id")
    sample = members.select("shard", "id", "vec").withColumn("rank", F.row_number().over(order))
    sample = sample.where(F.col("rank") <= SUB_FIT).join(sizes, "shard")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _vectors(pdf.sort_values("rank", ignore_index=True))
        k = int(min(-(-pdf.n.iat[0] // SHARD), max(1, len(x) // 4)))
        return pd.DataFrame({"shard": [pdf["shard"].iat[0]], "fitted": [fitted_to(x, k, seed).tobytes()]})

    centres = sample.groupBy("shard").applyInPandas(fit, "shard long, fitted binary").join(sizes, "shard")
    blocks = F.ceil(F.col("n") / SHARD_MOST).cast("int")
    dealt = members.select("shard", "id", "vec").join(sizes, "shard")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    centres = centres.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))

    def deal(nodes: pd.DataFrame, centre: pd.DataFrame) -> pd.DataFrame:
        x = _vectors(nodes)
        c = np.frombuffer(centre.fitted.iat[0]).reshape(-1, x.shape[1])
        near = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :wide]
        leaf = nodes["shard"].to_numpy()[:, None] * LEAVES + near
        return pd.DataFrame({"id": nodes.id, "leaves": list(leaf)})

    leaves = dealt.groupBy("shard", "block").cogroup(centres.groupBy("shard", "block"))
    leaves = leaves.applyInPandas(deal, "id long, leaves array<long>")
    leaves = leaves.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("leaves"))).alias("shards"))
    nodes = members.select("id", "copies", "vec").dropDuplicates(["id"])
    return nodes.join(leaves, "id").withColumn("shard", F.explode("shards"))


def cells(members: DataFrame) -> DataFrame:
    """The members with a task cell (shard, i, j): one for a shard, or one for each pair of blocks."""
    blocks = members.groupBy("shard").agg(
        F.ceil(F.count("*") / SHARD_MOST * 2).cast("int").alias("blocks")
    ).withColumn("blocks", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks")))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    out = members.join(blocks, "shard").withColumn("block", block).withColumn("other", other)
    return out.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


# -- in a task ------------------------------------------------------------------


def pruned(x: np.ndarray) -> np.ndarray:
    """Adjacency by robust pruning of the nearest candidates, and long edges; -1 fills short rows.

    Long edges go to the neighbours at twice, four times, ... the rank of the last candidate
    and to random members.  Of any two tight groups above ``CANDIDATES`` the smaller one, of
    s nodes, so reaches its ranks s to 2 s, which are its nearest nodes outside.
    """
    n = len(x)
    c = min(CANDIDATES, n - 1)
    if c < 1:
        return np.full((n, DEGREE), -1, np.int64)
    ranks = [c - 1]
    while 2 * ranks[-1] + 1 < n - 1:
        ranks.append(2 * ranks[-1] + 1)
    long = DEGREE + len(ranks) - 1
    out = np.full((n, long + RANDOM), -1, np.int64)
    rng = np.random.default_rng(n)
    for low in range(0, n, 512):
        rows = np.arange(low, min(n, low + 512))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -2
        near = np.argpartition(-sim, ranks, axis=1)
        out[rows[:, None], np.arange(DEGREE, long)] = near[:, ranks[1:]]
        other = rng.integers(0, n, (len(rows), RANDOM))
        out[rows[:, None], np.arange(long, long + RANDOM)] = np.where(other == rows[:, None], -1, other)
        near = near[:, :c]
        s = np.take_along_axis(sim, near, 1)
        order = np.argsort(-s, axis=1, kind="stable")
        near, s = np.take_along_axis(near, order, 1), np.take_along_axis(s, order, 1)
        dist = np.sqrt(np.maximum(0, 2 - 2 * s))
        v = x[near]
        between = np.sqrt(np.maximum(0, 2 - 2 * (v @ v.transpose(0, 2, 1))))
        alive = np.ones(near.shape, bool)
        taken = np.zeros(len(rows), np.int64)
        for k in range(c):
            take = alive[:, k] & (taken < DEGREE)
            out[rows[take], taken[take]] = near[take, k]
            taken[take] += 1
            covered = ALPHA * between[:, k, :] <= dist
            covered[:, : k + 1] = False
            alive &= ~(covered & take[:, None])
    return out


Adjacency = tuple[np.ndarray, np.ndarray]  # where a node's neighbours start, and all neighbours


def neighbours(adjacency: Adjacency, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``v``, neighbour) of all nodes in ``v``."""
    starts, flat = adjacency
    count = starts[v + 1] - starts[v]
    of = np.repeat(np.arange(len(v)), count)
    return of, flat[np.repeat(starts[v] - (np.cumsum(count) - count), count) + np.arange(len(of))]


def cosines(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the pairs (a, b), some at a time."""
    out = np.empty(len(a))
    for k in range(0, len(a), SLICE):
        out[k : k + SLICE] = np.einsum("ij,ij->i", x[a[k : k + SLICE]], x[b[k : k + SLICE]])
    return out


def in_range(x: np.ndarray, adjacency: Adjacency, queries: np.ndarray, least: float):
    """(query, node) positions with cosine >= least, as the search finds them.

    Queries go together while all their pairs with the shard stay below ``PAIRS``.  A query whose
    open vertices have more neighbours than ``DENSE`` of the shard reads the rest of
    the shard in one step, so a step never holds more than the pairs of its queries.
    """
    n = len(x)
    medoid = int((x @ x.mean(0)).argmax())
    degree = np.diff(adjacency[0])
    tile = int(min(256, max(1, PAIRS // max(1, n))))
    for low in range(0, len(queries), tile):
        q = queries[low : low + tile]
        row = np.arange(len(q))
        seen = np.zeros((len(q), n), bool)
        seen[row, q] = True
        seen[:, medoid] = True
        beam = np.stack([np.full(len(q), medoid), q], 1)
        score = np.stack([x[q] @ x[medoid], np.einsum("ij,ij->i", x[q], x[q])], 1)
        done = np.zeros(beam.shape, bool)
        by = row[(score[:, 0] >= least - SLACK) & (q != medoid)]
        found_q, found_n = [row, by], [q, np.full(len(by), medoid)]
        entered = False
        while not done.all():  # greedy: the medoid, then the best open vertex of each query's beam
            best = np.where(done, -np.inf, score).argmax(1) if entered else np.zeros(len(q), np.int64)
            entered = True
            go = np.flatnonzero(~done[row, best])
            done[row, best] = True
            r, v = neighbours(adjacency, beam[go, best[go]])
            r = go[r]
            fresh = ~seen[r, v]
            r, v = r[fresh], v[fresh]
            seen[r, v] = True
            sim = cosines(x, q[r], v)
            hit = sim >= least - SLACK
            found_q.append(r[hit])
            found_n.append(v[hit])
            slot = np.arange(len(r)) - np.searchsorted(r, r)  # r is sorted
            wide = int(slot.max(initial=-1)) + 1
            more = np.full((len(q), wide), -np.inf), np.zeros((len(q), wide), np.int64)
            more[0][r, slot], more[1][r, slot] = sim, v
            score, beam = np.concatenate([score, more[0]], 1), np.concatenate([beam, more[1]], 1)
            done = np.concatenate([done, np.isneginf(more[0])], 1)
            top = np.argsort(-score, axis=1, kind="stable")[:, :BEAM]
            beam, score, done = (np.take_along_axis(a, top, 1) for a in (beam, score, done))
        r, v = np.concatenate(found_q), np.concatenate(found_n)
        sim = cosines(x, q[r], v)
        while len(r):  # range expansion from all vertices found near the range
            hit = (sim >= least) & (v != q[r])
            yield q[r[hit]], v[hit]
            wide = np.bincount(r, degree[v], len(q)) > DENSE * n
            rest = np.flatnonzero(wide)
            if len(rest):
                near = x[q[rest]] @ x.T
                at, other = np.nonzero((near >= least) & ~seen[rest])
                yield q[rest[at]], other
                r, v = r[~wide[r]], v[~wide[r]]
            of, v = neighbours(adjacency, v)
            r = r[of]
            fresh = ~seen[r, v]
            code = np.unique(r[fresh] * n + v[fresh])
            r, v = code // n, code % n
            seen[r, v] = True
            sim = cosines(x, q[r], v)
            close = sim >= least - SLACK
            r, v, sim = r[close], v[close], sim[close]


def united(ids: np.ndarray, lists: list) -> Adjacency:
    """Adjacency with the lists of all shards and the reverse edges among the ids at hand."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    size = np.array([0 if o is None else len(o) for o in lists], np.int64)
    other = np.concatenate([o for o in lists if o is not None and len(o)] or [np.empty(0, np.int64)])
    a = np.repeat(np.arange(n), size)
    at = order[np.minimum(np.searchsorted(ids[order], other), max(0, n - 1))] if n else other
    here = ids[at] == other
    a, b = a[here], at[here]
    code = np.unique(np.concatenate([a * n + b, b * n + a]))
    a, b = code // max(n, 1), code % max(n, 1)
    return np.concatenate([[0], np.cumsum(np.bincount(a, minlength=n))]).astype(np.int64), b


def _vectors(pdf: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(pdf.vec), np.float64).reshape(len(pdf), -1)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    ids = pdf.id.to_numpy()
    near = pruned(_vectors(pdf))
    return pd.DataFrame({"id": ids, "near": [ids[a[a >= 0]] for a in near]})


def all_in_range(x: np.ndarray, least: float):
    """The same as ``in_range`` for every node, by comparing all pairs."""
    for low in range(0, len(x), 256):
        a, b = np.nonzero(x[low : low + 256] @ x.T >= least)
        yield a[a + low != b] + low, b[a + low != b]


def _search(least: float, exact: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        ids, x, copies = pdf.id.to_numpy(), _vectors(pdf), pdf.copies.to_numpy()
        block, cross = pdf.block.to_numpy(), pdf.i.iat[0] != pdf.j.iat[0]
        shard = pdf["shard"].iat[0]
        most = max(map(len, pdf.shards))
        shards = np.array([[*s, *[NO_SHARD] * (most - len(s))] for s in pdf.shards], np.int64)
        if exact:
            pairs = all_in_range(x, least)
        else:
            pairs = in_range(x, united(ids, list(pdf.near)), np.arange(len(ids)), least)
        links = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))
        for a, b in ((a[k : k + SLICE], b[k : k + SLICE]) for a, b in pairs for k in range(0, len(a), SLICE)):
            both = (shards[a][:, :, None] == shards[b][:, None, :]).any(2)
            mine = np.where(both, shards[a], NO_SHARD).min(1) == shard
            if cross:
                mine &= block[a] != block[b]
            np.add.at(links, a[mine], copies[b[mine]])
            for u, v in zip(*_forest(root, a, b)):
                u, v = _find(root, u), _find(root, v)
                root[max(u, v)] = min(u, v)
        top = np.array([_find(root, k) for k in range(len(ids))], np.int64)
        return pd.DataFrame({"id": ids, "links": links, "root": ids[top] if len(ids) else ids})

    return run


def _find(root: np.ndarray, k: int) -> int:
    while root[k] != k:
        root[k] = root[root[k]]
        k = root[k]
    return int(k)


def _forest(root: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Of the pairs, those that may still join two trees, each once."""
    ra, rb = root[a], root[b]
    keep = ra != rb
    code = np.unique(np.minimum(ra, rb)[keep] * len(root) + np.maximum(ra, rb)[keep])
    return code // len(root), code % len(root)


# -- the operator -----------------------------------------------------------------


def searched(reps: DataFrame, count: int, overlap: int, least: float, exact: bool = False) -> DataFrame:
    """(id, links, root) of each node and cell; ``exact`` compares all pairs of a shard."""
    members = dealt(reps, centroids(reps, min(count, CENTROIDS_MOST)), overlap)
    if count > CENTROIDS_MOST:
        members = refined(stored(members.drop("shards"), "shards"), 1 if overlap == 1 else 2)
    members = stored(cells(members), "members")
    if exact:
        return stored(
            members.groupBy("shard", "i", "j").applyInPandas(_search(least, True), "id long, links long, root long"),
            "found",
        )
    built = members.groupBy("shard", "i", "j").applyInPandas(_build, "id long, near array<long>")
    lists = stored(
        built.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "adjacency"
    )
    return stored(
        members.join(lists, "id")
        .groupBy("shard", "i", "j")
        .applyInPandas(_search(least, False), "id long, links long, root long"),
        "found",
    )


def recall(reps: DataFrame, links: DataFrame, least: float) -> float:
    """Share of a node's links, against all rows, that was found: the mean over nodes.

    The smaller one of the means over nodes with up to ``FEW`` links and with more.  The
    queries are bounded sets of the nodes for which no, few and many links were found, and
    stand for as many nodes as these kinds have, so no group outweighs the others.
    """
    kind = F.when(F.col("links") == 0, 0).when(F.col("links") <= FEW, 1).otherwise(2)
    kinds = stored(reps.select("id", "vec").join(links, "id").withColumn("kind", kind), "audit")
    nodes_of = {r.kind: r["count"] for r in kinds.groupBy("kind").count().collect()}
    sample = []
    for k in nodes_of:
        sample += kinds.where(F.col("kind") == k).orderBy(F.xxhash64(F.lit(99), "id")).limit(AUDIT).collect()
    by_size = {}
    for r in sample:
        by_size.setdefault(len(r.vec), []).append(r)
    probes = {k: (np.array([r.id for r in v]), np.stack([np.frombuffer(r.vec) for r in v])) for k, v in by_size.items()}

    def rows(batch: pa.RecordBatch):
        ids, hits = [], []
        mine, copies, vec = (c.to_pylist() for c in batch.columns)
        for size, (probe, p) in probes.items():
            at = [k for k, v in enumerate(vec) if len(v) == size]
            if at:
                close = np.stack([np.frombuffer(vec[k]) for k in at]) @ p.T >= least
                close &= np.array([mine[k] for k in at])[:, None] != probe
                ids += probe.tolist()
                hits += (np.array([copies[k] for k in at]) @ close).tolist()
        yield {"id": ids, "hits": hits}

    true = map_arrow(reps.select("id", "copies", "vec"), rows, "id long, hits long")
    true = dict(true.groupBy("id").agg(F.sum("hits")).collect())  # bounded by the queries
    asked = Counter(r.kind for r in sample)
    means = []
    for few in (True, False):
        of = [r for r in sample if true[r.id] and (true[r.id] <= FEW) == few]
        weight = [nodes_of[r.kind] / asked[r.kind] for r in of]
        if of:
            got = [min(r.links, true[r.id]) / true[r.id] for r in of]
            means.append(sum(w * g for w, g in zip(weight, got)) / sum(weight))
    return min(means, default=1.0)


def near_duplicates(vectors: DataFrame, least: float = 0.95, overlap: int = 4) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Null, empty and zero vectors, and those with a null or non-finite component, link
    with nothing.  Vectors of different lengths never link.  Rows that repeat a vec_id are
    vectors of their own, each with its own links and component; a null vec_id links with
    nothing and is kept.  Other columns are not read.
    """
    all_nodes = stored(nodes(vectors), "nodes")
    good = all_nodes.where("vec is not null and vec_id is not null")
    classes = good.groupBy("digest").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    first = classes.groupBy("low").agg(F.min("digest").alias("first"))
    # an id that other vectors have as well stands for the first of them; the others get ids beyond all
    other = F.xxhash64("digest").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    classes = classes.join(first, "low").withColumn("id", F.when(F.col("digest") == F.col("first"), F.col("low")).otherwise(other))
    classes = stored(classes.drop("first"), "classes")
    reps = good.join(classes, "digest").where("vec_id = low").dropDuplicates(["digest"])
    reps = stored(reps.select("id", "digest", "copies", "vec"), "nodes")
    rows = reps.count()
    count = max(1, -(-rows // SHARD))
    while rows:
        found = searched(reps, count, overlap, least)
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        if recall(reps, links, least) >= RECALL:
            break
        if overlap >= min(count, OVERLAP_MOST):
            found = searched(reps, 1, 1, least, exact=True)
            links = found.groupBy("id").agg(F.sum("links").alias("links"))
            break
        overlap *= 2
    if rows:
        edges = found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
        joined = components(edges)
    else:
        links = reps.select("id", F.lit(0).alias("links"))
        joined = reps.select("id", F.col("id").alias("component_id"))
    known = classes.join(links, "id", "left").join(joined, "id", "left")
    known = known.withColumn("component_id", F.coalesce("component_id", "id"))
    known = stored(known.select("digest", "copies", "low", "links", "component_id"), "known")
    lowest = known.groupBy("component_id").agg(F.min("low").alias("lowest"))
    known = known.join(lowest, "component_id").drop("component_id", "low")
    out = all_nodes.withColumn("digest", F.when(F.col("vec_id").isNotNull(), F.col("digest"))).join(known, "digest", "left")
    component = F.coalesce("lowest", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
