"""The pipeline's stages on the smallest tables and on odd rows."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tillcast.llm import knapsack_mix

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        counts.append((docs.count(), out.count()))
        docs = out
    assert all(after < before for before, after in counts[:3])
    assert docs.groupBy("doc_id").count().where("count > 3").count() == 0
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_stages_on_odd_rows(spark, odd, none):
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, odd, SF).count() >= 0, name
        assert stage(spark, none, SF).count() == 0, name
    kept = corpus_pipeline.near_dedup(spark, odd, SF).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 4, 5, 6, 7, 8, 11]


def test_an_id_with_two_texts_keeps_the_unique_one(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    for rows in ([(3, a), (5, a), (5, b)], [(3, b), (5, a), (5, b)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        kept = corpus_pipeline.near_dedup(spark, docs, SF).collect()
        assert sorted(r.text for r in kept) == [a, b]


def named(spark, rows):
    """Documents with columns of the names and kinds that the stages might use themselves."""
    return spark.createDataFrame(
        [(*r, 1.0, 2, "k", 3, {"a": 1}, "d", [1]) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, least double, twice long, mix_key string,"
        " mix_times int, map map<string,int>, digest string, row array<int>",
    )


def test_stages_on_clashing_names_and_maps(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, text + " x", "en", "b", 5), (3, None, "en", "b", 0)]
    rows += [(None, text, None, None, 5), (4, " ".join(f"v{k}" for k in range(50)), "en", "b", 5)]
    docs = named(spark, rows)
    kept = corpus_pipeline.near_dedup(spark, docs, SF)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4]
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns and {r.map["a"] for r in mixed.collect()} == {1}
    assert corpus_pipeline.quality_rules(spark, docs, SF).columns == docs.columns


def test_mixing_takes_what_the_operator_takes_for_repeated_and_unnamed_rows(spark):
    a, b, c = (" ".join([w] * n) for w, n in (("a", 42), ("b", 63), ("c", 7)))
    rows = [(None, a, "en", "x", 1)] * 2 + [(None, b, "en", "x", 1)] * 3 + [(5, c, "en", "y", 1)] * 5
    rows += [(6, c, "en", "y", 1), (None, a, "en", "y", 1), (None, a, "de", "x", 1), (7, "", "en", "x", 1)]
    docs = named(spark, rows)
    want = {r.source: r.taken for r in knapsack_mix.mixed(docs).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    got = {}
    for r in corpus_pipeline.mix_sources(spark, docs, SF).collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert got == {k: v for k, v in want.items() if v}
