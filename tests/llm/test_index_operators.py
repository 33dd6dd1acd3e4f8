"""Ranked search, resampling towards a target, and token files, against plain rewritings."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from lakeward.llm import registry, resampling, search, token_files

from . import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def odd_docs(seed=0, n=150):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Über", "naïve", "A1", "日本"]
    docs = [(i, " ".join(r.choice(words[: r.choice([5, 30, 64])]) for _ in range(r.choice([1, 7, 19, 20, 60])))) for i in range(n)]
    docs += [(900, None), (901, ""), (902, "?! \n"), (903, "w1 " * 30_000), (904, docs[3][1]), (None, docs[4][1]), (None, "w1"), (905, "w1"), (905, "w1"), (905, "W1, w2")]
    return docs + [(50, docs[5][1])] * 60


def frame(spark, rows, parts=5, extra=True):
    if not extra:
        return spark.createDataFrame(rows, DOCS).repartition(parts)
    return spark.createDataFrame([(*r, 7, "x") for r in rows], DOCS + ", score long, block string").repartition(parts)


@needs_tables
@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_target_resampling"])
def test_matches_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = c.sql(registry.ORACLES[name])
    got = [tuple(r) for r in registry.QUERIES[name](spark, SF).select(*want.columns).collect()]
    assert sorted(got, key=repr) == sorted(want.fetchall(), key=repr) and len(got) > 100


def ranked(docs, items, k):
    """The k best of each item, by the formula as it is stated."""
    own = [(i, brute.words(t)) for i, t in docs]
    sizes = [len(w) for _, w in own if w]
    n_docs, n_words, df = len(sizes), sum(sizes), Counter(t for _, w in own for t in set(w))
    out = []
    for item, text in items:
        best = []
        for i, w in own:
            count, score = Counter(w), 0
            m = 50 + (50 * len(w) * n_docs) // n_words if w else 0
            for t in set(brute.words(text)) & count.keys():
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * count[t]) // (1000 * count[t] + 20 * m))
            if score > 0:
                best.append((-score, i is None, i or 0, i))
        out += [(item, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(best, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k,docs_a_block,query_bytes", [(3, 4096, 1 << 20), (50, 16, 100), (500, 64, 1 << 20)])
def test_search_against_its_formula(spark, monkeypatch, k, docs_a_block, query_bytes):
    docs = odd_docs()
    items = [(1, "w1 w2 w2 w63"), (2, "über NAÏVE w50"), (3, None), (4, "none of these"), (5, " ".join(f"w{k}" for k in range(60))), (6, "w7"), (6, "w7"), (None, "a1 日本"), (8, "")]
    monkeypatch.setattr(search, "BLOCK_DOCS", docs_a_block)
    monkeypatch.setattr(search, "QUERY_BYTES", query_bytes)
    got = search.search(search.build_index(frame(spark, docs)), spark.createDataFrame(items, "item_id long, text string"), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == ranked(docs, items, k)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([("x", "a")], "item_id string, text string")
    assert search.search(search.build_index(docs.limit(0)), items).count() == 0
    assert search.search(search.build_index(docs), items.limit(0)).count() == 0
    assert [tuple(r) for r in search.search(search.build_index(docs), items).collect()] == [("x", 1, 1, 287 * (10**9 // 3000))]


def test_carry_arithmetic():
    r = random.Random(3)
    sliced = lambda xs: [sum((x >> s & 1) << i for i, x in enumerate(xs)) for s in range(max(xs, default=0).bit_length())]
    plain = lambda a, n: [sum((s >> i & 1) << j for j, s in enumerate(a)) for i in range(n)]
    for n in (1, 7, 300):
        a, b, w = [r.randrange(1 << 20) for _ in range(n)], [r.choice([0, 5, r.randrange(1 << 30)]) for _ in range(n)], r.choice([0, 1, 6, 15_000])
        assert plain(search.added(sliced(a), sliced(b)), n) == [x + y for x, y in zip(a, b, strict=True)]
        assert plain(search.times(sliced(a), w), n) == [x * w for x in a]
        for k in (1, 3, n):
            want = sorted((i for i in range(n) if b[i]), key=lambda i: (-b[i], i))[:k]
            assert [i for i in range(n) if search.best_of(sliced(b), k) >> i & 1] == sorted(want)


def resampled(docs, target, percent=25):
    """{row: (n_features, weight, score)} and the ids in the order in which they are drawn."""
    feats = lambda t: [f.encode() for w in [brute.words(t)] for f in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]
    buckets = lambda t: [zlib.crc32(f) % 10_000 for f in feats(t)]
    s, t = Counter(b for _, x in docs for b in buckets(x)), Counter(b for x in target for b in buckets(x))
    s_all, t_all, rows = sum(s.values()), sum(t.values()), []
    for i, x in docs:
        own = buckets(x)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in own]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(brute.words(x)) >= 20))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return sorted((r[:4] for r in rows), key=repr), [r[0] for r in fit[: percent * len(fit) // 100]]


@pytest.mark.parametrize("entries", [1 << 16, 50])
def test_resampling_against_its_formula(spark, monkeypatch, entries):
    monkeypatch.setattr(resampling, "BLOCK_ENTRIES", entries)
    docs, target = odd_docs(1), ["w1 w2 w3 w4", None, "w5 Über w5", ""]
    got = resampling.resample_to(frame(spark, docs), spark.createDataFrame([(t,) for t in target], "text string")).collect()
    rows, order = resampled(docs, target)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=repr) == rows
    held = sorted((r.rank, r.doc_id) for r in got if r["rank"] is not None)
    assert [r for r, _ in held] == [*range(1, len(order) + 1)] and [i for _, i in held] == order


def test_resampling_of_nothing(spark):
    docs = spark.createDataFrame([(i, f"a b{i} " * 12) for i in range(8)], DOCS)
    assert resampling.resample_to(docs.limit(0), docs).count() == 0
    assert sorted(r["rank"] for r in resampling.drawn(docs, docs.limit(0)).collect()) == [1, 2]


def test_matrix_is_stored(spark):
    matrix = resampling.count_matrix(frame(spark, [(1, "a b a"), (2, None)], 1))
    row = matrix.first()
    starts, at, n = (np.frombuffer(x, resampling.VECTOR) for x in (row.row_starts, row.buckets, row.counts))
    want = Counter(zlib.crc32(f) % 10_000 for f in (b"a", b"a", b"b", b"a b", b"b a"))
    assert os.path.isdir(matrix.staged_at.removeprefix("file://")) and (row.doc_id, row.n_words, starts.tolist()) == ([1, 2], [3, 0], [0, 4, 4])
    assert dict(zip(at.tolist(), n.tolist(), strict=True)) == want


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_blocks_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 127, 128, 129, 5000):
        for high in (1, 2, 300, 50_000, 2**32):
            for block in (8, 128, 256):
                ids = r.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
                ids[::17] = min(high * 9, 2**32) - 1  # outliers
                payload = token_files.pack(ids, block)
                assert (token_files.unpack(payload) == ids).all()
                a, b = sorted(r.integers(0, n + 3, 2).tolist())
                assert (token_files.unpack(payload, a, b) == ids[a:b]).all()
    few = r.integers(0, 200, 128_000).astype(np.uint32)
    few[::50] = 49_000
    assert len(token_files.pack(few)) < 1.3 * 128_000  # two bytes an id would take 256,000
    with pytest.raises(ValueError):
        token_files.unpack(b"none of these bytes at all")


def test_words_as_the_library(tokenizer):
    own, r = token_files.Words(), random.Random(2)
    texts = ["<|endoftext|> hi", "Ünïcode ÀÉ ß İstanbul ΑΣ", "á café", "it's 'S don'T '''s \"'s", " \x1c\x0b a\x85b", "１２ ½ Ⅷ", "漢字 かな", "a" * 900, "!?" * 300, "\x00a\x01", "ªº µ ×÷", "''re'll", ""]
    texts += ["".join(r.choice("ab'sS tredlvm0!\"ÀéßÿÞ×\n\t\x0b\x1c-_@") for _ in range(r.randint(1, 40))) for _ in range(3000)]
    for t in texts * 2:
        assert np.frombuffer(own.ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_token_files(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    docs = odd_docs(2)
    files = token_files.write_tokens(frame(spark, docs))
    got = sorted(files.documents().collect(), key=lambda r: r.start)
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in docs]
    sums = Counter((i, len(x), zlib.crc32(x.tobytes())) for (i, _), x in zip(docs, ids, strict=True))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sums
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    # the stream of ids, read by position from a few segments
    by = {}
    for (i, _), x in zip(docs, ids, strict=True):
        by.setdefault((i, len(x), zlib.crc32(x.tobytes())), x)
    stream = np.concatenate([by[r.doc_id, r.n_tokens, r.ids_crc32] for r in got])
    for a, b in ((0, 10), (490, 1700), (len(stream) - 5, len(stream) + 9)):
        read = sorted(files.read(a, b).collect())
        assert sum((r.ids for r in read), []) == stream[a:b].tolist() and read[0].position == a
    assert token_files.write_tokens(frame(spark, docs).limit(0)).documents().count() == 0


@needs_tables
def test_op13(spark, tokenizer):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    start = 0
    for r in registry.QUERIES["op13_token_files"](spark, SF).orderBy("doc_id").collect():
        ids = np.array([*tokenizer.encode(rows.pop(r.doc_id), add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not rows
