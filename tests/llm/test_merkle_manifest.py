"""The manifest against a plain recursion, over several blocks and on odd rows."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tillcast.llm import merkle_manifest


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def proof(level, k):
    """Siblings of leaf k on the way to the root, and the root."""
    out = []
    while len(level) > 1:
        run = k // 8 * 8
        out.append((level[run:k], level[k + 1 : run + 8]))
        level = [h("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        k //= 8
    return out, level[0]


def plain(rows, changed):
    trees = {}
    for r in rows:
        trees.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    trees = {k: sorted(v, key=lambda x: x[:3]) for k, v in trees.items()}
    langs = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    leaves = {k: [x[2] for x in trees[k]] for k in langs}
    subroots = [proof(leaves[k], 0)[1] for k in langs]
    out = []
    for t, k in enumerate(langs):
        above, root = proof(subroots, t)
        for i, (_, _, own, r) in enumerate(trees[k]):
            sides = [("".join(a), "".join(b)) for a, b in proof(leaves[k], i)[0] + above]
            node = other = leaf(r, changed(r))
            for a, b in sides:
                node = h(a + node + b)
            out.append((r.doc_id, own, subroots[t], root, sides, other, node, node == root))
    return out


def check(df, rows, changed):
    got = [(*r[:4], [tuple(s) for s in r.proof], *r[5:]) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(plain(rows, changed), key=repr)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_blocks_of_any_depth_give_the_plain_tree(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle_manifest, "DEPTH", depth)
    monkeypatch.setattr(merkle_manifest, "BLOCK", 8**depth)
    rows = [(k * 7 % 211, f"T{k}", "abcde"[min(4, k % 13)], "s", k) for k in range(211)] + [(900, "alone", None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    tampered = F.when(F.col("doc_id") % 2 == 0, F.lower("text")).otherwise(F.col("text"))
    df = merkle_manifest.manifest(docs, tampered)
    check(df, docs.collect(), lambda r: r.text.lower() if r.doc_id % 2 == 0 else r.text)
    assert df.where("verified").count() == sum(r[0] % 2 == 1 or r[1] == "alone" for r in rows)


def test_odd_and_empty_rows(spark, odd, none):
    docs = odd.withColumn("tree", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("node", F.lit(1))
    check(merkle_manifest.manifest(docs), odd.collect(), lambda r: r.text)
    changed = merkle_manifest.manifest(docs, F.lit(None).cast("string")).collect()
    assert [r.doc_id for r in changed if r.verified] == [4]  # its text is null
    assert merkle_manifest.manifest(none).count() == 0


def test_one_document_is_its_own_root(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle_manifest.manifest(docs).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof == [] and row.verified


def test_a_language_is_split_over_blocks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "ROWS", 100)
    rows = spark.range(1500).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
        F.lit(1).cast("long").alias("n_chars"),
    )
    check(merkle_manifest.manifest(rows), rows.collect(), lambda r: r.text)
