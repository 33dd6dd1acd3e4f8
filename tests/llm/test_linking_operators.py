import os
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from lakeward.llm import common, decontamination, embedding_dedup, jaccard, registry, revisits

from . import brute

DOCS = "doc_id long, text string"


def edited(r, words, times):
    w = list(words)
    for _ in range(times):
        w[r.randrange(len(w))] = f"w{r.randrange(9999)}"
    return w


def corpus(seed=0):
    r = random.Random(seed)
    base = [[f"v{r.randrange(400)}" for _ in range(r.randint(30, 120))] for _ in range(12)]
    passage = [f"p{k}" for k in range(40)]
    docs = []
    for i in range(260):
        w = edited(r, base[i % 12 if i < 180 else 0], r.choice([0, 0, 1, 2, 4, 9]))
        if i % 7 == 0:
            w += passage
        docs.append((i, " ".join(x.upper() if r.random() < 0.1 else x for x in w)))
    return docs + [(900, None), (901, ""), (902, " \t "), (903, "one two"), (904, "ONE  two"), (905, "a " * 9000), (906, "a b " * 4000)]


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_components(spark, width, percent):
    docs = corpus()
    df = spark.createDataFrame([(*d, 0) for d in docs], DOCS + ", n long").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(df, width, percent).collect()}
    assert got == brute.jaccard(docs, width, percent)


def test_jaccard_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, None)], DOCS)
    got = sorted(map(tuple, jaccard.link_documents(docs, 3, 90).collect()), key=str)
    assert got == [(1, 4, 1), (1, 4, 1), (2, 4, 1), (3, 0, 3), (None, 4, None)]
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3]
    assert jaccard.link_documents(docs.limit(0)).count() == 0


def test_jaccard_ids_with_two_texts(spark):
    r = random.Random(6)
    a, b, c = ([f"{x}{r.randrange(999)}" for _ in range(80)] for x in "abc")
    text = " ".join
    rows = [(1, text(a)), (5, text(a)), (5, text(b)), (9, text([*b, "end"])), (6, text(c)), (7, text(c)), (7, ""), (8, ""), (8, text([*c, "end"])), (20, ""), (20, "one")]
    got = sorted((x.doc_id, x.component_id) for x in jaccard.link_documents(spark.createDataFrame(rows, DOCS), 3, 90).collect())
    assert got == [(1, 1), (5, 1), (5, 1), (6, 6), (7, 6), (7, 6), (8, 6), (8, 6), (9, 1), (20, 20), (20, 20)]
    want = sorted([(1, text(a)), (5, text(b)), (6, text(c)), (7, ""), (8, ""), (20, ""), (20, "one")])
    assert sorted(map(tuple, jaccard.keep_one(spark.createDataFrame(rows, DOCS), 3, 90).collect())) == want


def test_rows_are_numbered_whatever_they_come_from(spark, tmp_path):
    spark.createDataFrame([(k, f"t{k}") for k in range(40)], DOCS).repartition(3).write.parquet(str(tmp_path / "d"))
    scan = spark.read.parquet(str(tmp_path / "d"))
    assert jaccard.plain_scan(scan.where("doc_id > 3").select("text", "doc_id")) and not jaccard.plain_scan(scan.selectExpr("doc_id", "explode(array(1, 2)) as text"))
    for df, n in ((scan, 40), (scan.selectExpr("doc_id", "explode(array(text, 'b')) as text"), 80), (scan.unionByName(scan), 80), (spark.createDataFrame([(1, "a"), (1, "a")], DOCS), 2)):
        numbered = jaccard.numbered_rows(df)
        assert numbered.select("__row").distinct().count() == n and sorted(numbered.collect(), key=str) == sorted(numbered.collect(), key=str)


@pytest.mark.parametrize("stored", [False, True])
def test_keep_one_keeps_every_text(spark, tmp_path, stored):
    """Against all pairs of texts: one row of each group of near copies, whatever the ids and columns."""
    docs = [(i % 5 if i % 3 else None, t, i) for i, (_, t) in enumerate(corpus(4)[:120] + corpus(4)[-7:] * 3)]
    df = spark.createDataFrame(docs, DOCS + ", __file long")
    if stored:
        df.repartition(3).write.parquet(str(tmp_path / "docs"))
        df = spark.read.parquet(str(tmp_path / "docs"))
    group = brute.jaccard([(n, t) for _, t, n in docs], 5, 80)
    kept = jaccard.keep_one(df).collect()
    assert df.columns == ["doc_id", "text", "__file"] and {tuple(r) for r in kept} <= set(docs)
    assert sorted(group[r["__file"]][1] for r in kept) == sorted({c for _, c in group.values()})


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_prefixes_of_similar_sets_meet(percent):
    rng = np.random.default_rng(3)
    for share in (0.0, 0.5, 1.0):
        flags = rng.random(jaccard.SKETCH) < share
        prefixes = jaccard.Prefixes(percent, flags)
        for n in (3, 20, 39, 55, 70, 200, 1500, 7000, 9000):
            for _ in range(4):
                a = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
                n_ = len(a)
                lose = rng.integers(0, n_ + 1)
                gain = rng.integers(0, n_ + 1)
                both = n_ - lose
                if 100 * both < percent * (n_ + gain):
                    lose, gain = (n_ - -(-percent * n_ // 100)), 0
                b = np.unique(np.concatenate([rng.permutation(a)[: n_ - lose], rng.integers(1, 2**63, gain, dtype=np.uint64)]))
                if 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)) and len(b):
                    assert len(np.intersect1d(prefixes.of(a), prefixes.of(b))), (n, share)


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(200)] + [(7, 7), (None, 3)]
    want = brute.Union({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if a is not None:
            want.join(a, b)
    got = {x.node: x.root for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == want.find(x) for x in want.up) and all(k in want.up for k in got)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_with_hubs(spark):
    edges = [(5000, i) for i in range(400)] + [(6000, 700 + i) for i in range(300)] + [(399, 700)] + [(9000, 9001)]
    got = {x.node: x.root for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(got) == 704 and {r for n, r in got.items() if n < 9000} == {0} and got[9001] == 9000


def test_shared_folder(spark):
    df = common.stage(spark.range(5), "t")
    assert df.count() == 5 and df.staged_at.startswith(spark.conf.get("spark.checkpoint.dir"))
    common.unstage(df)
    assert not os.path.exists(df.staged_at.removeprefix("file://"))


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(2)
    for n in (3, 200, 5000):
        a = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
        for gone in (0, 1, n // 3, n):
            b = np.union1d(a[gone:], rng.integers(1, 2**63, n // 5, dtype=np.uint64))
            for longs in (jaccard.NARROW, 64, 256):
                apart = np.bitwise_count((jaccard.parity(a, longs) ^ jaccard.parity(b, longs)).view(np.uint64)).sum()
                assert apart <= len(np.setxor1d(a, b))


def test_without(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "b")], DOCS)
    bad = spark.createDataFrame([(2,), (None,), (77,)], "doc_id long")
    assert [r.text for r in common.without(docs, bad, {"doc_id": docs.doc_id}).collect()] == ["a"]


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((20, 16))
    rows = [(i, [float(np.float32(v)) for v in base[0 if i < 500 else i % 20] + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.15, 0.4])]) for i in range(900)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0, None] * 8), (2004, []), (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (2007, rows[0][1]), (2008, [float("inf")] * 16)]
    df = spark.createDataFrame([(*r, 3) for r in rows] + [(None, rows[0][1], 3)], "vec_id long, embedding array<float>, rep int")
    got = {r.vec_id: r for r in embedding_dedup.link_vectors(df).collect()}
    assert got[None].n_links == 0 and got[None].component_id is None and got[None].kept
    sound = [r for r in rows if r[0] < 1000 or r[0] == 2007]
    x = np.array([r[1] for r in sound], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    groups = brute.Union([r[0] for r in rows])
    for a, b in zip(*np.nonzero(near), strict=True):
        groups.join(sound[a][0], sound[b][0])
    groups.join(2005, 2006)
    links = dict(zip((r[0] for r in sound), near.sum(1), strict=True)) | {2005: 1, 2006: 1}
    wrong = [i for i, _ in rows if (got[i].n_links, got[i].component_id, got[i].kept) != (links.get(i, 0), groups.find(i), groups.find(i) == i)]
    assert len(wrong) <= 0.01 * len(rows), wrong
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def hot_cone(n, pairs, dim=64, inside=0.9, turned=0.31):
    """Vectors of a cone of mutual cosine about `inside`; the last `pairs` of them nearly repeat the first."""
    rng = np.random.default_rng(8)
    off = rng.standard_normal((n, dim))
    off[:, 0] = 0
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    x = np.sqrt(1 - inside) * off
    x[:, 0] = np.sqrt(inside)
    turn = rng.standard_normal((pairs, dim))
    x[n - pairs :] = x[:pairs] + turn * (turned / np.linalg.norm(turn, axis=1, keepdims=True))
    return x.astype(np.float32)


def test_vectors_of_a_hot_cone(spark):
    x = hot_cone(10000, 1000)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.link_vectors(df).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    groups = brute.Union(range(len(x)))
    for a, b in zip(*np.nonzero(near), strict=True):
        groups.join(int(a), int(b))
    assert near.sum() >= 2 * 1000 and got == {i: (near[i].sum(), groups.find(i)) for i in range(len(x))}


def test_passes_find_and_count_every_link(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 24))
    x = (base[rng.integers(0, 300, 3000)] + 0.2 * rng.standard_normal((3000, 24))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 1, 24) for i, v in enumerate(x)], "rep long, v array<float>, mult long, dim int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    for bits in (0, 6):
        found = embedding_dedup.links(df, bits).groupBy("rep").sum("n").collect()
        assert near.sum() > 1000 and {r[0]: r[1] for r in found if r[1]} == {i: int(n) for i, n in enumerate(near.sum(1)) if n}
    assert embedding_dedup.passes_for(0) == 1 and embedding_dedup.passes_for(8) > embedding_dedup.passes_for(4)


def test_large_runs_meet_window_by_window(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAST", 50)
    x = hot_cone(700, 100)
    df = spark.createDataFrame([(i, v.tolist(), 1, 64) for i, v in enumerate(x)], "rep long, v array<float>, mult long, dim int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    found = {r[0]: r[1] for r in embedding_dedup.links(df, 2).groupBy("rep").sum("n").collect() if r[1]}
    assert found == {i: int(n) for i, n in enumerate(near.sum(1)) if n}


def test_vectors_in_double_precision(spark):
    big = [(1, [1e300, 1.0]), (2, [2e300, 2.0]), (3, [1.0, 1e-12]), (4, [1.0, 0.0]), (5, [0.0, 1e-200])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.link_vectors(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5)}


CAPTURES = "record_id long, url string, captured long, kind string, etag string, last_modified string, headers map<string,string>, digest string, outcome int"


def test_revisits(spark):
    u = "http://www.Site.example:80/a?utm_source=x&b=1#top"
    rows = [
        (1, "https://site.example/a?b=1", 10, "response", "e1", None, {"etag": "e1", "content-type": "t", "Date": "1"}, "d1", 0),
        (2, u, 20, "revisit", "W/e1", None, {"date": "2", "content-length": "0"}, None, 0),
        (3, u, 20, "response", "e2", "m", {"date": "3"}, "d3", 0),
        (4, u, 30, "revisit", "e1", "m", None, None, 0),
        (5, u, 40, "revisit", None, "m", {}, None, 0),
        (6, u, 41, "revisit", None, None, None, None, 0),
        (7, u, 5, "revisit", "e1", None, None, None, 0),
        (8, None, 50, "revisit", "e1", None, None, None, 0),
        (9, u, None, None, "e1", None, None, None, 0),
    ]
    got = {r.record_id: r for r in revisits.resolve(spark.createDataFrame(rows, CAPTURES)).collect()}
    assert {k: (r.outcome, r.source_id) for k, r in got.items()} == {
        1: ("full", None), 2: ("resolved", 1), 3: ("full", None), 4: ("mismatch", None), 5: ("resolved", 3), 6: ("unvalidated", 3), 7: ("unmatched", None), 8: ("unmatched", None), 9: ("unmatched", None),
    }
    assert got[2].merged_headers == {"etag": "e1", "content-type": "t", "date": "2"} and got[2].source_digest == "d1" and got[1].canonical_url == "site.example/a?b=1"
    many = [(i, u, i, "response" if i == 0 else "revisit", "e", None, None, "d", 0) for i in range(3000)]
    assert revisits.resolve(spark.createDataFrame(many, CAPTURES)).where("source_id = 0").count() == 2999
    assert revisits.resolve(spark.createDataFrame([], CAPTURES)).count() == 0


SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@tables
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = c.sql(registry.ORACLES[name])
    got = registry.QUERIES[name](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


@tables
def test_pipeline(spark):
    docs = common.table(spark, SF, "documents")
    whole = {r.doc_id: r.text for r in docs.collect()}
    items = {r.item_id: r.text for r in common.table(spark, SF, "benchmark").collect()}
    quality_of = {r.doc_id: r.quality for r in common.table(spark, SF, "labels").collect()}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = common.stage(apply(spark, docs, SF), name)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality":
            assert sum(quality_of.get(i) == 0 for i in after) <= 1 and sum(quality_of.get(i) == 1 for i in set(before) - set(after)) <= 3
        if name == "near_duplicates":
            groups = brute.jaccard(before.items(), 5, 80)
            assert set(after) == {i for i, (_, root) in groups.items() if i == root}
        if name == "decontamination":
            assert set(after) == {i for i, t in before.items() if not brute.contamination(t, items)[1]}
        if name == "personal_data":
            assert set(after) == set(before) and not any(sum(brute.personal(t)[0]) for t in after.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(packed.doc_id) == set(after) and packed.groupby("sequence_id").length.sum().max() <= 2048 and len(after) < len(whole)
    assert decontamination.decontaminate(docs, common.table(spark, SF, "benchmark")).count() == len(after)
