"""The operators against brute force on a small table, and on odd and empty rows."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql.functions import lit, pmod, xxhash64
from tokenizers import Tokenizer

from tillcast.llm import (
    adaptive_rules,
    common,
    deleted_interpolation,
    flat_graph,
    hilbert_pack,
    hyperminhash,
    knapsack_mix,
    pairwise_quality,
    queries,
    toxic_terms,
    url_filter,
)
from tests.compare import connect, spark_rows, sql_rows
from tests.llm.conftest import TEXT

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    got = spark_rows(queries.QUERIES[name](spark, SF))
    assert got == sql_rows(connect(SF), queries.ORACLES[name])


def test_word_hashes_tell_words_apart():
    texts = [b"", b" a  A b", "é É\x0bx".encode(), b"ab ba aab"]
    h, ends = common.word_hashes(texts)
    flat = [w for t in texts for w in words(t.decode())]
    assert len(h) == len(flat) and list(ends) == [0, 3, 6, 9]
    assert len(set(h.tolist())) == len(set(flat))
    assert dict(zip(flat, h)) == {w: x for w, x in zip(flat, h)}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1: mixing -----------------------------------------------------------------


def test_fitted_is_the_nearest_subset_sum():
    random.seed(1)
    for _ in range(200):
        lengths = {random.randint(0, 40): random.randint(0, 5) for _ in range(5)}
        budget = random.randint(0, 200)
        take = knapsack_mix.fitted(lengths, budget)
        assert all(0 <= take[k] <= lengths[k] for k in lengths)
        sums = {0}
        for k, c in lengths.items():
            for _ in range(c):
                sums |= {x + k for x in sums}
        best = min(abs(x - budget) for x in sums if x <= 2 * budget)
        assert abs(sum(k * v for k, v in take.items()) - budget) == best


def test_long_texts_are_fitted_to_the_nearest_sum():
    assert knapsack_mix.fitted({100_000: 1}, 99_000) == {100_000: 1}
    assert knapsack_mix.fitted({100_000: 10}, 990_000) == {100_000: 10}
    assert knapsack_mix.fitted({100_000: 1, 70_000: 2}, 140_000) == {100_000: 0, 70_000: 2}
    assert knapsack_mix.fitted({900_000: 3}, 1_300_000) == {900_000: 1}
    assert knapsack_mix.fitted({900_000: 3}, 1_400_000) == {900_000: 2}
    histogram = {"source": "a", "size": [100_000], "count": [10], "source_size": 1_000_000, "target": 990_000.0}
    quota = knapsack_mix._quota(pd.DataFrame(histogram))
    assert (quota.times.tolist(), quota.extra.tolist()) == ([0], [10])


def test_mix_meets_targets(spark):
    df = documents(spark)
    rows = knapsack_mix.mixed(df).collect()
    texts = {r.doc_id: r for r in df.collect()}
    sizes = collections.Counter()
    for r in texts.values():
        sizes[r.source] += len(words(r.text))
    order = sorted(sizes)
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, free = {}, set(order)
    while True:  # reshare what is above the cap until nothing is
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in order if s not in free)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        free -= over
    target = {s: share.get(s, 3 * sizes[s]) for s in order}
    taken = collections.Counter()
    for r in rows:
        assert r.size == len(words(texts[r.doc_id].text)) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    longest = max(r.size for r in rows)
    assert all(abs(taken[s] - target[s]) <= longest for s in order)
    again = {r.doc_id: r.taken for r in knapsack_mix.mixed(df.repartition(5)).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_mix_of_odd_rows(odd, none):
    rows = knapsack_mix.mixed(odd).collect()
    assert len(rows) == 12
    assert all(r.taken == 0 for r in rows if r.size == 0) and all(r.taken <= 3 * r.size for r in rows)
    assert knapsack_mix.mixed(none).count() == 0


# -- 2: packing ----------------------------------------------------------------


def test_hilbert_key_takes_unit_steps():
    grid = np.array(list(itertools.product(range(8), repeat=3)))
    key = hilbert_pack.hilbert_key(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("which", ["table", "odd"])
def test_packed_round_trip(spark, odd, which):
    df = documents(spark) if which == "table" else odd
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    want = collections.Counter(
        (r.doc_id, (*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2)) for r in df.collect()
    )
    pieces = hilbert_pack.packed(df, queries.vocabulary()).collect()
    by_sequence = collections.defaultdict(list)
    by_place = collections.defaultdict(list)
    for p in pieces:
        assert len(p.ids) == p.length and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        by_sequence[p.sequence_id].append(p)
        by_place[p.doc_id].append(p)
    for group in by_sequence.values():
        at = 0
        for p in sorted(group, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 4096 or at & (at - 1) == 0 and at <= 4096
    once = {k for k, _ in want if sum(c for (d, _), c in want.items() if d == k) == 1}
    for doc in once:
        ids = [x for p in sorted(by_place[doc], key=lambda p: p.start) for x in p.ids]
        assert want[(doc, tuple(ids))] == 1
    assert sum(p.length for p in pieces) == sum(len(ids) * c for (_, ids), c in want.items())


def test_packed_empty(none):
    assert hilbert_pack.packed(none, queries.vocabulary()).count() == 0


# -- 3: LM scoring ---------------------------------------------------------------


def brute_scores(texts):
    """Counts and base scores from the contract; the model's score from its definition."""
    tokens = {i: [*words(t), None] for i, t in texts.items()}
    part = {i: 0 if crc(i) % 5 == 1 else 2 if crc(i) % 5 == 2 else 1 for i in texts}
    one = {p: collections.Counter(w for i in texts if part[i] == p for w in tokens[i]) for p in (1, 2)}
    two = {
        p: collections.Counter(b for i in texts if part[i] == p for b in zip([0, *tokens[i]], tokens[i])) for p in (1, 2)
    }
    heads = {p: sum(part[i] == p for i in texts) for p in (1, 2)}
    c1, c2, n = one[1] + one[2], two[1] + two[2], sum((one[1] + one[2]).values())
    v = len(c1)
    cells = collections.Counter()
    for i in texts:
        if part[i] == 2:
            for a, b in zip([0, *tokens[i]], tokens[i]):
                context = heads[1] if a == 0 else one[1][a]
                f1, f2 = one[1][b] / max(1, sum(one[1].values())), two[1][(a, b)] / max(context, 1)
                cell = [int(deleted_interpolation._cells(np.array([f * (v + 1)]))[0]) for f in (f1, f2)]
                bucket = int(deleted_interpolation.bucket_of(np.array([float(context)]))[0])
                cells[(bucket * 256 + cell[0]) * 256 + cell[1]] += 1
    keys = sorted(cells)
    weights = deleted_interpolation.learned(np.array(keys, np.int64), np.array([cells[k] for k in keys], float))
    out = {}
    for i, t in tokens.items():
        base = sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        score = 0.0
        for a, b in zip([0, *t], t):
            context = heads[1] + heads[2] if a == 0 else c1[a]
            w = weights[int(deleted_interpolation.bucket_of(np.array([float(context)]))[0])]
            score += math.log10(w[0] / (v + 1) + w[1] * c1[b] / n + w[2] * c2[(a, b)] / max(context, 1))
        out[i] = (part[i] == 0, len(t), sum(c1[w] > 0 for w in t), n, base, score)
    return out


def test_scores_match_brute_force(spark):
    df = documents(spark)
    want = brute_scores({r.doc_id: r.text for r in df.collect()})
    rows = deleted_interpolation.score(df).collect()
    assert len(rows) == len(want)
    for r in rows:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4]) and r.score == pytest.approx(w[5])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_odd_rows(odd, none):
    rows = deleted_interpolation.score(odd).collect()
    assert len(rows) == 12 and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {1}
    assert deleted_interpolation.score(none).count() == 0


def test_two_hops_count_what_one_hop_counts(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    docs = common.stored(docs, "docs")
    monkeypatch.setattr(deleted_interpolation, "TOKENS", 1 << 12)
    texts = common.stored(deleted_interpolation.blocks(docs, 1, 2, 5), "blocks")
    assert texts.count() > 15

    def counted(direct, buckets):
        monkeypatch.setattr(deleted_interpolation, "DIRECT", direct)
        rows, known = deleted_interpolation.corpus_counts(texts, buckets)
        out = {}
        for r in sorted(rows.collect(), key=lambda r: r.bucket):
            one, two = (deleted_interpolation.from_planes(r[c], np.uint64) for c in ("one", "two"))
            out.setdefault((r.block, r.order), []).append(np.stack([one, two]))
        return {k: np.concatenate(v, 1) for k, v in out.items()}, known, rows.count()

    want, vocabulary, rows = counted(1000, 30)
    for buckets in (30, 7):
        got, known, fewer = counted(4, buckets)
        assert known == vocabulary and got.keys() == want.keys()
        assert all((got[k] == want[k]).all() for k in want)
        assert fewer <= rows * np.ceil(np.sqrt(buckets)) / 30
    empty = texts.limit(0)
    assert deleted_interpolation.corpus_counts(empty, 30)[0].count() == 0


# -- 5: rules --------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {k + x for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for x in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def check_counts(df):
    texts = collections.Counter((r.doc_id, brute_counts(r.text)) for r in df.collect())
    rows = adaptive_rules.judged(df).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert collections.Counter((r.doc_id, tuple(r[c] for c in names)) for r in rows) == texts
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    return rows


def test_rules_match_brute_force(spark):
    df = documents(spark)
    rows = check_counts(df)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r for r in rows if quality.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in rows if quality.get(r.doc_id) == 0) == 0
    kept = {r.doc_id for r in adaptive_rules.accepted(df).collect()}
    assert kept == {r.doc_id for r in rows if r.kept}


def test_rules_on_odd_rows(odd, none):
    check_counts(odd)
    assert adaptive_rules.accepted(odd).columns == odd.columns
    assert adaptive_rules.judged(none).count() == 0


def test_sketches_merge_to_the_sketch_of_all(spark):
    df = spark.range(5000).selectExpr("id % 3 as g", "pmod(hash(id), 1000) / 7.0 as rate_x")
    parts = adaptive_rules.merged(adaptive_rules.sketched(df, ["g"], ["rate_x"]), [])
    whole = adaptive_rules.sketched(df, [], ["rate_x"])
    assert spark_rows(parts) == spark_rows(whole)
    q = adaptive_rules.quartiles(whole, []).first()
    exact = df.selectExpr("percentile(rate_x, array(0.25, 0.5, 0.75)) as p").first().p
    assert [q.q1, q.q2, q.q3] == pytest.approx(exact, rel=0.03)


# -- 6: URLs ----------------------------------------------------------------------


def test_urls(spark):
    rows = [
        (1, "http://WWW.a.com/en/1?x=/es/"), (2, "https://example.com/en/"), (3, "http://b.example.com/en/x#y"),
        (4, "http://m.www.example.com/en/q"), (5, "http://x.net/fr/1"), (6, "http://net/es/"), (7, "http://notnet.org/es/"),
        (8, None), (9, "no scheme"), (10, "http://a.com?q"), (11, "a://b://c/d"), (11, "a://b://c/d"), (12, ""),
    ]
    got = {r.page_id: r for r in url_filter.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    rule = {k: r.rule for k, r in got.items()}
    assert rule == {
        1: "com/", 2: "example.com/en/", 3: "example.com/en/", 4: "www.example.com/en/", 5: "net/fr/", 6: "net/es/",
        7: None, 8: None, 9: None, 10: None, 11: None, 12: None,
    }
    assert (got[1].host, got[1].path) == ("www.a.com", "/en/1") and (got[10].host, got[10].path) == ("a.com", "")
    assert (got[11].host, got[11].path) == ("b:", "//c/d") and (got[8].host, got[8].path) == ("", "")
    assert [got[k].verdict for k in (1, 2, 4, 5)] == ["allow", "block", "allow", "block"]
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judged(empty).count() == 0


def test_url_model_learns(spark):
    rows = [(f"h{k}.org", f"/{'spam' if k % 2 else 'news'}/{k}", "block" if k % 2 else "allow") for k in range(200)]
    labelled = spark.createDataFrame(rows, "host string, path string, label string")
    pages = spark.createDataFrame([(k, f"http://z{k}.org/{'spam' if k % 2 else 'news'}/{k}") for k in range(300, 340)], "page_id long, url string")
    got = url_filter.judged(pages, labelled=labelled).collect()
    assert all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in got)


def test_url_model_on_urls_that_no_rule_decides(spark):
    rng = random.Random(6)
    plain = [w for w in TEXT.split() if len(w) > 3]
    urls = []
    for k in range(120):
        kept = "".join(rng.sample(plain, 2))
        urls.append((f"https://{rng.choice(('', 'www.', 'blog.', 'm.'))}{kept}.org/{rng.choice(('en', 'de', 'fr'))}/{k}", "allow"))
        bad = rng.choice(("cheap-pills", "spam-farm", "casino-spins", "cheap-loans", "xxx-cams", "pills-cheap"))
        urls.append((f"http://{rng.choice(('', 'www.'))}{bad}-{kept[:3]}.org/{rng.choice(('en', 'de', 'fr'))}/{k}", "block"))
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judged(pages).collect()}
    right = sum(got[k].verdict == v for k, (_, v) in enumerate(urls))
    assert all(r.rule is None for r in got.values()) and right >= 0.95 * len(urls)


def test_url_rules_and_scores_equal_plain_python(spark):
    rng = random.Random(4)
    hosts = ["example.com", "WWW.example.com", "a.www.example.com", "xexample.com", "b.net", "net", "com", "c.org", ""]
    paths = ["", "/", "/en/", "/en/1", "/EN/", "/es/x?y=/fr/", "/fr/#/en/", "/de/fr/", "?/en/", "/fr/" + "k" * 5000]
    rows = [(k, rng.choice(("http://", "x://", "http:/", "")) + rng.choice(hosts) + rng.choice(paths)) for k in range(300)]
    df = spark.createDataFrame([(*r, "h", "p", "r", "v", 0.5, 1) for r in [*rows, (300, None)]],
        "page_id long, url string, host string, path string, rule string, ruled string, score double, label int")
    got = {r.page_id: r for r in url_filter.judged(df).collect()}
    for k, url in rows:
        rest = url.partition("://")[2] if "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = host.lower()
        fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert got[k].verdict == (verdict or ("block" if got[k].score > 0.5 else "allow"))
    # the model by hand: distinct n-grams of host and path, hashed to columns, in one vector of length one
    weights, bias = url_filter.trained(url_filter.labelled_urls(spark))
    for k in (0, 1, 2, 7):
        columns = set()
        for part, text in enumerate((got[k].host, got[k].path)):
            data = b"\x02" + text.encode() + b"\x03"
            for n in url_filter.GRAMS:
                for at in range(len(data) - n + 1):
                    x = 1 + part
                    for c in data[at : at + n]:
                        x = (x ^ c) * 0x100000001B3 % (1 << 64)
                    columns.add((x >> 20) % url_filter.COLUMNS)
        score = sum(weights[c] for c in columns) / max(1, len(columns)) ** 0.5 + bias
        assert got[k].score == pytest.approx(1 / (1 + math.exp(-score)))


# -- 7 and 8: classifiers -----------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_matches_edit_distance():
    random.seed(2)
    terms = ["abca", "abcab", "bacab", "cabbacabba", "aabbccaab"]
    automaton = toxic_terms.Automaton(terms)
    pool = ["".join(random.choices("abc", k=random.randint(1, 11))) for _ in range(3000)]
    pool += [t[:k] + c + t[k + 1 :] for t in terms for k in range(len(t)) for c in "abcx"]
    for w in pool:
        best = min(((distance(w, t), k) for k, t in enumerate(terms) if distance(w, t) <= toxic_terms.edits_allowed(t)), default=None)
        assert automaton.match(w) == (best and best[::-1])


def test_quotation_counts_apart():
    m = toxic_terms.Matcher([("stupid", 1.0)])
    plain, quoted, typo = (m.features(t) for t in ("you are stupid", 'he said "stupid" once', "you are stpuid stuupid"))
    assert plain[0] > 0 and plain[1] == 0 and quoted[0] == 0 and quoted[1] > 0 and typo[2] > 0
    assert not m.features("a kind word").any() and not m.features("").any()


def test_rare_clear_terms_are_learned(spark):
    rows = [(f"common{k} rest{k % 7}" + (" vilest" if k < 8 else ""), 1) for k in range(1500)]
    rows += [(f"plain{k} rest{k % 7}", 0) for k in range(3000)]
    terms = dict(toxic_terms.learned_terms(spark.createDataFrame(rows, "text string, toxic int")))
    assert set(terms) == {"vilest"}


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r for r in labels.collect()}
    quality = [r for r in pairwise_quality.judged(docs, labels).collect() if r.doc_id in truth]
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) for r in quality)
    right = [r.predicted == truth[r.doc_id].quality for r in quality if r.held_out]
    assert sum(right) >= 0.95 * len(right)
    toxic = [r for r in toxic_terms.judged(docs, labels).collect() if r.doc_id in truth]
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in toxic)
    clean = [r for r in toxic if truth[r.doc_id].toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    caught = [r.predicted for r in toxic if truth[r.doc_id].toxic == 1 and r.held_out]
    assert sum(caught) >= 0.7 * len(caught)


def test_classifiers_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (3, 0, 1), (7, 0, None), (8, None, 1), (None, 1, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for op in (pairwise_quality.judged, toxic_terms.judged):
        for given in (labels, labels.limit(0)):
            rows = op(odd, given).collect()
            assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
        assert op(none, labels).count() == 0
    assert pairwise_quality.preferred(odd, labels).columns == odd.columns


# -- 9: embeddings ------------------------------------------------------------------


def test_flat_graph_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "SHARD", 40)
    monkeypatch.setattr(flat_graph, "SHARD_MOST", 60)  # some shards are cut into blocks
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 16))
    x = np.concatenate([rng.standard_normal((200, 16)), *(b + rng.standard_normal((5, 16)) * 0.05 for b in base), base[:1].repeat(30, 0)])
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, [1.0, 2.0]), (906, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("digest", common.F.lit(1))
    got = {r.vec_id: r for r in flat_graph.near_duplicates(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    found = sum(got[k].n_links for k in range(len(x)))
    assert found >= flat_graph.RECALL * (link.sum() - len(x))
    assert all(got[k].n_links <= link[k].sum() - 1 for k in range(len(x)))
    assert len({got[k].component_id for k in range(500, 530)}) == 1
    assert [got[k].n_links for k in range(900, 907)] == [0, 0, 0, 0, 0, 1, 1] and got[906].component_id == 905
    assert flat_graph.near_duplicates(df.limit(0)).count() == 0


def test_dense_groups_that_are_linked_are_found():
    rng = np.random.default_rng(8)
    a = rng.standard_normal(64)
    a /= np.linalg.norm(a)
    b = rng.standard_normal(64)
    b -= b @ a * a
    b = 0.965 * a + np.sqrt(1 - 0.965**2) * b / np.linalg.norm(b)
    x = np.concatenate([c + rng.standard_normal((k, 64)) * 0.004 for c, k in ((a, 130), (b, 210))])
    x = np.concatenate([x, rng.standard_normal((1000, 64))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x))
    near = [ids[r[r >= 0]] for r in flat_graph.pruned(x)]
    graph = flat_graph.united(ids, near)
    got = {(int(u), int(v)) for p, q in flat_graph.in_range(x, graph, ids, 0.95) for u, v in zip(p, q)}
    want = {(int(u), int(v)) for u, v in np.argwhere(x @ x.T >= 0.95) if u != v}
    assert sum(u < 130 <= v for u, v in want) > 20_000
    assert got <= want and len(got) >= 0.99 * len(want)


def test_recall_is_audited_and_exact_when_missed(spark, monkeypatch):
    rng = np.random.default_rng(9)
    pairs = np.repeat(rng.standard_normal((40, 32)), 2, 0) + rng.standard_normal((80, 32)) * 0.02
    dense = rng.standard_normal(32) + rng.standard_normal((300, 32)) * 0.02
    x = np.concatenate([pairs, dense])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.95).sum(1) - 1
    reps = common.stored(flat_graph.nodes(df).selectExpr("vec_id as id", "1L as copies", "vec"), "reps")
    links = spark.createDataFrame([(k, int(n) if k >= 80 else 0) for k, n in enumerate(want)], "id long, links long")
    assert want[:80].min() == 1 and flat_graph.recall(reps, links, 0.95) < flat_graph.RECALL
    monkeypatch.setattr(flat_graph, "in_range", lambda x, graph, queries, least: iter(()))
    monkeypatch.setattr(flat_graph, "SHARD_MOST", 150)  # also pairs of blocks
    got = {r.vec_id: r.n_links for r in flat_graph.near_duplicates(df).collect()}
    assert got == dict(enumerate(want.tolist()))


def test_two_levels_of_centroids_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "CENTROIDS_MOST", 2)
    monkeypatch.setattr(flat_graph, "SHARD", 60)
    monkeypatch.setattr(flat_graph, "SHARD_MOST", 150)
    monkeypatch.setattr(flat_graph, "SUB_FIT", 200)
    rng = np.random.default_rng(10)
    x = np.repeat(rng.standard_normal((150, 16)), 4, 0) + rng.standard_normal((600, 16)) * 0.1
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.95).sum(1) - 1
    reps = common.stored(flat_graph.nodes(df).selectExpr("vec_id as id", "1L as copies", "vec"), "reps")
    found = flat_graph.searched(reps, 10, 2, 0.95)
    got = dict(found.groupBy("id").agg({"links": "sum"}).collect())
    assert all(got[k] <= want[k] for k in got) and sum(got.values()) >= 0.95 * want.sum() > 500


def test_a_dense_group_is_searched_in_bounded_memory():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3500, 64))
    x[:2000] = rng.standard_normal(64) + 0.12 * rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x))
    graph = flat_graph.united(ids, [r[r >= 0] for r in flat_graph.pruned(x)])
    tracemalloc.start()
    found = sum(len(a) for a, _ in flat_graph.in_range(x, graph, ids, 0.95))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == sum(len(a) for a, _ in flat_graph.all_in_range(x, 0.95)) > 3_000_000
    assert peak < 200 << 20


def test_repeated_and_null_vector_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (None, [1.0, 0.0]), (None, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, digest string, id int")
    got = sorted(map(tuple, flat_graph.near_duplicates(df).collect()), key=repr)
    # vector 1 of id 1 links with 2, vector 2 of id 1 with 3; without an id a vector links with nothing
    links = {(r[0], r[1]) for r in got}
    assert links == {(1, 1), (2, 1), (3, 1), (None, 0)}
    assert {r[2] for r in got if r[0] in (1, 2, 3)} == {1} and all(r[3] for r in got if r[0] is None)


def test_bounded_takes_the_same_rows_however_many_share_a_hash(spark):
    df = spark.range(50_000).selectExpr("id", "id % 2 AS two")
    key = xxhash64("id")
    first = [r.id for r in common.bounded(df, key, 100, "id").collect()]
    assert len(first) == 100 and first == [r.id for r in df.orderBy(pmod(key, lit(1 << 32)), "id").limit(100).collect()]
    assert common.bounded(df, xxhash64("two"), 100, "id").count() == 100
    assert common.bounded(df.limit(0), key, 100, "id").count() == 0


# -- 10: MinHash ----------------------------------------------------------------------


def brute_components(texts, width):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(texts, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(hyperminhash, "BLOCK", 16)  # large groups are cut
    random.seed(3)
    texts = {r.doc_id: r.text for r in documents(spark).limit(60).collect()}
    base = [f"t{random.randint(0, 400)}" for _ in range(120)]
    for k in range(40):  # a group of variants around the threshold
        w = list(base)
        for _ in range(random.randint(0, 9)):
            w[random.randrange(len(w))] = f"u{k}"
        texts[5000 + k] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = hyperminhash.near_duplicates(df, width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_of_odd_rows(odd, none):
    rows = hyperminhash.near_duplicates(odd).collect()
    assert len(rows) == 12
    by = {r.doc_id: r for r in rows}
    assert {by[k].component_id for k in (1, 2, 3, 10)} == {1} and by[2].kept is False
    assert by[None].component_id is None and by[None].kept
    assert all(by[k].n_shingles == 0 and by[k].component_id == k for k in (4, 5, 6))
    assert by[7].n_shingles == 1
    assert hyperminhash.near_duplicates(none).count() == 0


def test_registers_estimate_jaccard():
    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
    a, b = np.sort(pool[:2200]), np.sort(pool[200:2400])
    got = hyperminhash.estimate(
        hyperminhash.registers(a)[None], hyperminhash.registers(b)[None], np.array([2200]), np.array([2200])
    )[0]
    assert abs(got - 2000 / 2400) < 0.1


def test_tokens_learned_by_one_task_serve_the_next(monkeypatch):
    path = queries.vocabulary()
    first = hilbert_pack.kept_tokens(path)
    texts = [b"kept words, kept", b"", b"it's 12"]
    ids = first.of(texts)
    assert ids == hilbert_pack.Tokens(path).of(texts)
    again = hilbert_pack.kept_tokens(path)
    monkeypatch.setattr(hilbert_pack.Tokens, "_learn", lambda self, pieces: 1 / 0 if pieces else None)
    assert again.of(texts) == ids


def test_unknown_words_of_latin_letters_go_straight_to_the_merges(monkeypatch):
    path = queries.vocabulary()
    letters = [chr(c) for c in range(0x41, 0x100) if chr(c).isalpha()]
    texts = [f"{c} {c}{c}x y{c}z" for c in letters] + ["It's a Straße, ÉTÉ 42", "x" * 200 + " ÿ"]
    others = ["ſt İx ǅ", "éte ́", "漢字かな ไทย", "a­b  c\u0085d", "<|EndOfText|> a", ""]
    encode = Tokenizer.from_file(path).encode
    want = {t: np.array(encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts + others}
    tokens = hilbert_pack.Tokens(path)
    assert tokens.of([t.encode() for t in others]) == [want[t] for t in others]
    monkeypatch.setattr(hilbert_pack, "CACHED", 3)  # forgotten, learned again
    monkeypatch.setattr(tokens, "_encoded", lambda word: 1 / 0 if word.isalpha() or " " in word else encoded(word))
    encoded = hilbert_pack.Tokens(path)._encoded
    for _ in range(2):
        assert tokens.of([t.encode() for t in texts]) == [want[t] for t in texts]
        assert max(map(len, tokens.known)) <= hilbert_pack.CHUNK
