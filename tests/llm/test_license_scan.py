"""License scan against brute force on the smallest table and on odd rows."""

from __future__ import annotations

import random
import re
import time

from tillcast.llm import license_scan


def pairs(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return set(zip(w, w[1:]))


def test_licenses_match_brute_force(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (docs, odd):
        rows = license_scan.scanned(df).collect()
        want = {}
        for r in df.collect():
            p = pairs(r.text)
            hits = [n for n, t in sorted(license_scan.TEMPLATES) if len(p & pairs(t)) >= 0.8 * len(pairs(t))]
            want[r.doc_id] = ",".join(hits)
        assert {r.doc_id: r.licenses for r in rows} == want and len(rows) == df.count()
    assert any(want_row.n_licenses for want_row in license_scan.scanned(docs).collect())
    assert license_scan.scanned(none).count() == 0


def test_every_kind_of_license_line_in_the_tables(spark):
    kinds = {
        r"licensed under the apache license, version": "apache-2.0",
        r"released under the mit license": "mit",
        r"this work is licensed under the gnu general public license, version": "gpl",
        r"all rights reserved": "reserved",
        r"licensed under cc by-nc": "cc-by-nc",
    }
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {
        r.doc_id: ",".join(sorted(n for k, n in kinds.items() if re.search(k, (r.text or "").lower()))) for r in docs.collect()
    }
    assert set(",".join(want.values()).split(",")) == {"", *kinds.values()}
    assert {r.doc_id: r.licenses for r in license_scan.scanned(docs).collect()} == want


def test_containment_counts_in_the_window_only(spark):
    full = dict(license_scan.TEXTS)
    gpl = "this work is licensed under the gnu general public license"
    words = gpl.split()
    scattered = " filler words between here ".join(f"{a} {b}" for a, b in zip(words, words[1:]))
    rest = " x y z" * 50
    cases = {
        scattered + rest + " this work is": "",
        "a b " + gpl + ", version 3" + rest: "gpl",
        "This work is licensed under the GNU Lesser General Public License, version 3." + rest: "lgpl",
        "Licensed under CC BY-NC-SA 4.0. Released under the MIT License." + rest: "cc-by-nc-sa,mit",
        "Licensed under CC BY 4.0.": "cc-by",
    }
    for name, text in full.items():
        cases[rest + text + rest] = name
        cut = text.split()
        cases[" ".join(w for k, w in enumerate(cut) if k % 40)] = name
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in license_scan.scanned(df).collect()}
    assert [got[k] for k in range(len(cases))] == list(cases.values())


def test_the_stated_probability(spark):
    known = license_scan.known_templates(spark)
    for _, found in known:
        held = {x for _, other in known if len(other) == len(found) for x in other}
        least = license_scan.worst(len(found), len(set(found)), len(held))
        assert least >= 0.5 and license_scan.retrieval(least) >= 0.998997
    assert license_scan.retrieval(0.1) < 0.25 and license_scan.retrieval(0.5, 1, 1) == 0.5


def test_altered_texts_and_notices_are_found(spark):
    rng = random.Random(11)
    cases = {}
    for name, text in (*license_scan.TEXTS, *license_scan.NOTICES):
        words, whole = text.split(), pairs(text)
        if len(words) < 5:
            continue
        for kind in range(3):
            new = list(words)
            while True:  # as long as the brute-force containment stays above the limit
                tried, k = list(new), rng.randrange(len(new))
                if kind == 0:
                    tried[k] = f"altered{k}"
                elif kind == 1:
                    tried.insert(k, f"inserted{k}")
                else:
                    del tried[k : k + 3]
                if len(pairs(" ".join(tried)) & whole) < 0.82 * len(whole) or len(tried) > 1.15 * len(words):
                    break
                new = tried
            cases[len(cases)] = (name, "before all this " * 3 + " ".join(new) + " and after" * 5)
    df = spark.createDataFrame([(k, t) for k, (_, t) in cases.items()], "doc_id long, text string")
    got = {r.doc_id: r.licenses.split(",") for r in license_scan.scanned(df).collect()}
    lost = [name for k, (name, _) in cases.items() if not any(x == name or x.startswith(name) for x in got[k])]
    # a notice that lost its own words may be a variant's, as GPL and AGPL differ in one
    assert len(lost) <= 0.02 * len(cases), lost
    assert not [n for n in lost if n.endswith("-full")]


def test_many_notices_in_one_text(spark):
    text = "all rights reserved x y " * 8000
    df = spark.createDataFrame([(1, text, "a", 2, 3, "n")], "doc_id long, text string, key string, at int, row int, names string")
    started = time.time()
    assert [tuple(r) for r in license_scan.scanned(df).collect()] == [(1, "reserved", 1)]
    assert time.time() - started < 60
