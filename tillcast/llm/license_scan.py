"""License scan: MinHash bands over overlapping windows retrieve templates, containment verifies.

A template is a notice of one sentence or a whole license text: L two-word shingles, n of
them distinct.  Templates of one L share a class.  A text is covered by overlapping
windows of each class, ``ROOM`` times L places and a step, which is L / ``STEPS``; so every
stretch of up to ``ROOM`` times L places lies in one of them whole.  A window's
signature is the minima, under ``BANDS`` times ``BAND`` hash functions, of the shingles that
any template of the class holds; other words cannot change what a template shares with
the window.  Windows and templates that agree on a band of ``BAND`` minima meet.

A window that holds 80 % of a template shares 0.8 n shingles with it.  What else counts in it is
no more than the class holds, u in all, nor than the window's other places: the Jaccard
similarity is at least 0.8 n / min(u, 0.2 n + 1.375 L), which for each template here is 0.5
or more (:func:`worst`).  With 24 bands of two the window is retrieved with a probability of
at least 1 - (1 - 0.5 ** 2) ** 24 = 0.999 (:func:`retrieval`).  Retrieved windows are verified exactly: the template counts if the
window holds at least ``LEAST`` of its shingles.  Of two templates found in one place the
one with more shingles counts, so the LGPL is not the GPL, and a notice inside a license
text is not named apart.

Built-in functions only.  The text is read once; what goes on from there are the places of
words that some template holds, keyed by text, class and window.  The tables of the
templates, which are a parameter and small, are broadcast.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import stored

BANDS, BAND = 24, 2
ROOM, STEPS = 1.25, 8
LEAST = 0.8
#: Short statements by which licenses are named in texts.
NOTICES = (
    ("agpl", "this work is licensed under the gnu affero general public license"),
    ("agpl", "this program is free software you can redistribute it under the terms of the gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("artistic", "licensed under the artistic license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "released under the bsd license"),
    ("cc-by", "this work is licensed under a creative commons attribution license"),
    *(("cc-by", f"licensed under cc by {k}") for k in (1, 2, 3, 4)),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial license"),
    ("cc-by-nd", "licensed under cc by nd"),
    *(("cc-by-nc-nd", f"licensed under cc by nc nd {k}") for k in (1, 2, 3, 4)),
    *(("cc-by-nc-sa", f"licensed under cc by nc sa {k}") for k in (1, 2, 3, 4)),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike license"),
    ("cc0", "this work is released under cc0"),
    ("gfdl", "under the terms of the gnu free documentation license"),
    ("gpl", "this program is free software you can redistribute it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license"),
    ("isc", "released under the isc license"),
    ("lgpl", "this library is free software you can redistribute it under the terms of the gnu lesser general public license"),
    ("lgpl", "this work is licensed under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("reserved", "all rights reserved"),
)
#: Whole license texts, named after their files.
TEXTS = tuple(
    (f"{p.stem}-full", p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))
)
TEMPLATES = NOTICES + TEXTS


def shingles(text: Column) -> Column:
    """Hashes of the consecutive two-word shingles of lower-cased letters and digits."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    follow = F.slice(hashed, 2, F.greatest(F.size(hashed) - 1, F.lit(0)))
    return F.filter(F.zip_with(hashed, follow, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b))), lambda x: x.isNotNull())


def retrieval(similarity: float, bands: int = BANDS, band: int = BAND) -> float:
    """Probability that a window and a template of this Jaccard similarity share a band."""
    return 1 - (1 - similarity**band) ** bands


def worst(length: int, distinct: int, held: int) -> float:
    """The least Jaccard similarity of a window with ``LEAST`` of a template, its class holding so many."""
    other = (1 - LEAST) * distinct + (ROOM + 1 / STEPS) * length
    return LEAST * distinct / min(max(held, distinct), other)


MARK = 0  # stands in every text, so that none is lost


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table out of one JSON literal, which the JVM reads without Python."""
    names = [part.split()[0] for part in schema.split(", ")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    array = F.from_json(F.lit(text), f"array<struct<{schema.replace(' ', ':')}>>".replace(",:", ","))
    return spark.range(1).select(F.explode(array).alias("r")).select("r.*")


def known_templates(spark: SparkSession, templates: tuple = TEMPLATES) -> list[tuple[str, list[int]]]:
    """(name, shingle hashes in the text's order), sorted by name."""
    table = _table(spark, list(templates), "name string, text string")
    known = table.select("name", shingles(F.col("text")).alias("s")).collect()
    if any(len(r.s) < 2 for r in known):
        raise ValueError("a template needs three words")
    return sorted((r.name, list(r.s)) for r in known)


def _minima() -> list[Column]:
    return [F.min(F.xxhash64("key", F.lit(i))).alias(f"m{i}") for i in range(BANDS * BAND)]


def _bands(signed: DataFrame, *keep: str) -> DataFrame:
    """(keep, band): a hash for each band of a signature ``m0``, ``m1``, ..."""
    keys = [F.xxhash64(F.lit(b), *(f"m{b * BAND + r}" for r in range(BAND))) for b in range(BANDS)]
    return signed.select(*keep, F.explode(F.array(*keys)).alias("band"))


def _windows(places: DataFrame) -> DataFrame:
    """Each place in all windows of its class that hold it, by the windows' numbers."""
    last = F.floor(F.col("at") / F.col("step"))
    first = F.greatest(F.floor((F.col("at") - F.col("width")) / F.col("step")) + 1, F.lit(0))
    return places.withColumn("window", F.explode(F.sequence(first.cast("int"), last.cast("int"))))


def scanned(docs: DataFrame, templates: tuple = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, licenses (names in order, joined by commas), n_licenses.

    Null, empty and short texts hold none.  Repeated rows are documents of their own, and
    equal texts get equal results.  Long texts cost in proportion to their words.  The
    templates, (name, text) of three words or more, are a parameter; several may share a
    name.  Other columns are not read.
    """
    spark = docs.sparkSession
    known = known_templates(spark, templates)
    content, classes = [], {}
    for t, (_, found) in enumerate(known):
        size, least = len(found), -int(-LEAST * len(set(found)) // 1)
        content += [(t, size, least, x) for x in dict.fromkeys(found)]
        step = max(1, size // STEPS)
        classes[size] = (size, step, -int(-ROOM * size // 1) + step, min(least, classes.get(size, (least,))[-1]))
    contents = stored(_table(spark, content, "template int, size int, least int, key long"), "templates")
    classes = _table(spark, list(classes.values()), "size int, step int, width int, enough int")
    keys = contents.select("key").union(_table(spark, [(MARK,)], "key long")).distinct()

    # the places of templates' shingles in the texts
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), shingles(text).alias("s"))
    marked = F.concat("s", F.array(F.lit(MARK).cast("long")))
    places = rows.select("doc_id", "row", F.posexplode(marked).alias("at", "key"))
    places = stored(places.join(F.broadcast(keys), "key"), "places")
    held = F.broadcast(contents.select("size", "key").distinct().join(classes, "size"))
    places_of = places.where(F.col("key") != MARK).select("row", "at", "key").join(held, "key")

    # windows of texts that hold enough of a class at all
    enough = places_of.groupBy("row", "size", "enough", "key").agg(F.lit(1)).groupBy("row", "size", "enough")
    enough = enough.agg(F.count("*").alias("held")).where("held >= enough").select("row", "size")
    members = stored(_windows(places_of.join(enough, ["row", "size"], "left_semi")), "windows")
    signed = members.groupBy("row", "size", "window", "enough").agg(F.count("*").alias("held"), *_minima())
    met = _bands(signed.where("held >= enough"), "row", "size", "window")
    own = contents.groupBy("template", "size").agg(*_minima())
    found = met.join(F.broadcast(_bands(own, "template", "size")), ["size", "band"])
    found = found.select("row", "size", "window", "template").distinct()

    # exact containment in the window that was retrieved
    shared = members.select("row", "size", "window", "at", "key").join(found, ["row", "size", "window"])
    shared = shared.join(F.broadcast(contents), ["template", "size", "key"])
    once = shared.groupBy("row", "template", "window", "least", "key").agg(F.min("at").alias("at"), F.max("at").alias("to"))
    sure = once.groupBy("row", "template", "window", "least").agg(
        F.count("*").alias("held"), F.min("at").alias("start"), F.max("to").alias("end")
    )
    sure = stored(sure.where("held >= least").drop("least"), "sure")

    # a place belongs to the template of which it holds most
    covered = sure.select("row", "held", F.explode(F.sequence("start", "end")).alias("at"))
    owner = covered.groupBy("row", "at").agg(F.max("held").alias("most"))
    middle = F.floor((F.col("start") + F.col("end")) / 2).cast("int")
    left = sure.withColumn("at", middle).join(owner, ["row", "at"]).where("held = most")
    names = _table(spark, [(t, name) for t, (name, _) in enumerate(known)], "template int, name string")
    named = left.select("row", "template").distinct().join(F.broadcast(names), "template")
    named = named.groupBy("row").agg(F.array_sort(F.collect_set("name")).alias("names"))
    out = places.where(F.col("key") == MARK).select("doc_id", "row").join(named, "row", "left")
    found = F.coalesce("names", F.array().cast("array<string>"))
    return out.select(
        "doc_id", F.array_join(found, ",").alias("licenses"), F.size(found).cast("long").alias("n_licenses")
    )
