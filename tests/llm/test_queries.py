"""The registered queries, as they stand, on the smallest tables, against plain rewritings."""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeward.llm import common, embedding_dedup, packing, quality, registry, sharding, toxicity

from . import brute

SF, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in common.table(spark, SF, "documents").collect()}


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def result(spark, name):
    return registry.QUERIES[name](spark, SF)


def test_op1(spark, texts):
    got = {r.doc_id: r for r in result(spark, "op1_personal_data").collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        counts, digest, told = brute.personal(t)
        r = got[i]
        assert ((r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256) == (counts, digest)
        assert set(filter(None, told.split(","))) <= set(r.spans.split(",")) and ("token = " in t) <= (r.n_secret > 0)


def test_op2(spark, texts, tokenizer):
    got = {r.doc_id: r for r in result(spark, "op2_token_counts").collect()}
    for i, t in texts.items():
        n = len(tokenizer.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 512)


def test_op3(spark):
    """Held-out rows of a larger table; labels are noisy, so the bounds leave room."""
    docs, labels = common.table(spark, MORE, "documents"), common.table(spark, MORE, "labels")
    model = toxicity.train(*toxicity.training_texts(docs, labels))
    truth = {r.doc_id: r.toxic for r in labels.where("toxic is not null").collect()}
    rows = [r for r in toxicity.score_toxicity(docs, model).where("held_out").collect() if r.doc_id in truth]
    assert np.mean([r.predicted for r in rows if truth[r.doc_id]]) > 0.8 and np.mean([r.predicted for r in rows if not truth[r.doc_id]]) < 0.01
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and (r.score >= 0.7) == r.predicted for r in rows)
    small = result(spark, "op3_toxicity").collect()
    assert len(small) == common.table(spark, SF, "documents").count() and all(0 <= r.score <= 1 for r in small)


def test_op4(spark, texts, tokenizer):
    got = result(spark, "op4_packing").toPandas()
    assert set(got.doc_id) == set(texts)
    for i, own in got.sort_values("start").groupby("doc_id"):
        ids = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
        assert (own.doc_tokens == len(ids)).all() and (own.start == own.length.cumsum() - own.length).all() and own.length.sum() == len(ids)
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in zip(own.start, own.length, own.ids_crc32, strict=True))
    held = got.sort_values(["sequence_id", "offset"])
    assert (held.groupby("sequence_id").length.cumsum() - held.length == held.offset).all()
    sums = held.groupby("sequence_id").length.sum()
    assert sums.max() <= 2048 and 2048 * len(sums) <= 1.03 * sums.sum() + 2048 and packing.solve(np.zeros(0), np.zeros(0)) == []


def test_op6(spark, texts):
    """Weights, the cut behind k, and the k largest keys, all computed anew."""
    labels = common.table(spark, SF, "labels")
    ids = lambda quality_, most, cut: {r.doc_id for r in quality.sampled_labels(labels, quality_, most, cut).collect()}
    target_ids = ids(1, quality.TARGET_ROWS, False)

    def grams(t):
        h = [zlib.crc32(("\x01CAPS" if len(w) > 1 and w.isupper() else w).encode()) for w in quality.WORDS.findall(t)]
        pairs = [quality.REPEAT if a == b else (a * 1_000_003 + b * 8_191 + 7) % 2_147_483_647 for a, b in zip(h, h[1:], strict=False)]
        return [x % quality.BUCKETS for x in h + pairs]

    own = {i: grams(t) for i, t in texts.items()}
    raw, target = Counter(g for x in own.values() for g in x), Counter(g for i in target_ids for g in own.get(i, ()))
    n_raw, n_target = (sum(c.values()) + quality.SMOOTHING * quality.BUCKETS for c in (raw, target))
    ratio = lambda g: math.log((target[g] + quality.SMOOTHING) / n_target) - math.log((raw[g] + quality.SMOOTHING) / n_raw)
    want = {i: sum(map(ratio, x)) / (len(x) + quality.PRIOR) for i, x in own.items()}
    got = result(spark, "op6_quality").collect()
    assert len(got) == len(texts) and all(abs(r.log_weight - want[r.doc_id]) < 1e-9 for r in got)
    seen = sorted(want[i] for i in ids(1, quality.CUT_ROWS, True) if i in want)
    cut = seen[int((1 - quality.KEEP_GOOD) * len(seen))]
    keep = sum(w >= cut - 1e-12 for w in want.values())
    assert sum(r.kept for r in got) == keep and min(r.key for r in got if r.kept) > max([r.key for r in got if not r.kept], default=-math.inf)


def test_op7(spark):
    rows = {r.vec_id: r.embedding for r in common.table(spark, MORE, "embeddings").collect()}
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    groups = brute.Union(ids.tolist())
    for a, b in zip(*np.nonzero(near), strict=True):
        groups.join(int(ids[a]), int(ids[b]))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in registry.QUERIES["op7_embedding_dedup"](spark, MORE).collect()}
    assert got == {int(i): (int(n), groups.find(int(i)), groups.find(int(i)) == i) for i, n in zip(ids, near.sum(1), strict=True)}


def test_long_inputs_and_clashing_columns(spark):
    """Very long texts and vectors, and columns named like the results."""
    long = "the words go on and on " * 40_000
    rows = [(1, long, 0.5, "x", True, "k", 1), (2, long + "end", 0.5, "x", True, "k", 1), (3, None, None, None, None, None, None), (3, "short", 1.0, "y", False, "z", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, law string, held_out boolean, key string, virtual_slot int")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    scored = toxicity.score_toxicity(docs, toxicity.train(["you snerkel " * 9] * 20, ["fine day"] * 20)).collect()
    assert len(scored) == 4 and abs(scored[0].score - scored[1].score) < 0.05 and all(0 <= r.score <= 1 for r in scored)
    assert quality.resample(docs, labels).count() == 4 and quality.keep_good(docs, labels).columns == docs.columns
    cut = sharding.shard_documents(docs).collect()
    assert sorted(r["size"] for r in cut) == sorted([16, 21, len(long) + 16, len(long) + 19]) and {r.law for r in cut} == {"bytes"}
    vectors = [(1, [float(k % 7) for k in range(20_000)], 9), (2, [float(k % 7) + 1e-9 for k in range(20_000)], 9), (3, [1.0] * 20_000 + [5.0], 9)]
    got = embedding_dedup.link_vectors(spark.createDataFrame(vectors, "vec_id long, embedding array<double>, n_links int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_op9(spark, texts):
    got = result(spark, "op9_sharding").toPandas()
    assert len(got) == len(texts) and set(got.law) == {"bytes"} and set(got.shard) <= set(range(sharding.SHARDS))
    for r in got.itertuples():
        t = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(t) + 16, zlib.crc32(t))
    assert all(sorted(x.slot) == list(range(len(x))) for _, x in got.groupby("shard"))
    held = got.groupby("shard")["size"].sum()
    assert held.max() - held.min() <= max(got["size"])


def test_op10(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, "op10_jaccard_join").collect()}
    assert got == brute.jaccard(texts.items(), 3, 90) and any(c != i for i, (_, c) in got.items())
