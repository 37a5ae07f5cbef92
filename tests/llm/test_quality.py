import collections
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lastro.llm import quality


def brute_contexts(texts):
    table = quality.index_vectors().astype(int)
    sums = np.zeros((quality.SLOTS, quality.SIZE), int)
    known = quality._Tokens()
    for text in texts:
        slots = [s for w in (text or "").encode().split() for s in known[w]]
        for i, slot in enumerate(slots):
            for j in range(max(0, i - quality.WINDOW), min(len(slots), i + quality.WINDOW + 1)):
                if j != i:
                    sums[slot] += table[slots[j]]
    return sums


def test_context_vectors_equal_brute_force():
    texts = ["The cat sat!! on THE mat, 12 times.", "", "one", "*** --- ***", "a a a b"]
    known = quality._Tokens()
    slots = [np.array([s for w in t.encode().split() for s in known[w]], np.uint16) for t in texts]
    assert (quality.context_sums(slots, quality.index_vectors()) == brute_contexts(texts)).all()
    assert not quality.context_sums([np.array([], np.uint16)], quality.index_vectors()).any()


@pytest.mark.parametrize("tokens, keys", [(1 << 20, 1 << 17), (40, 8)])
def test_every_word_has_a_vector_of_its_own(spark, monkeypatch, tokens, keys):
    slots = collections.defaultdict(list)
    for i in range(3000):
        slots[xxhash.xxh3_64_intdigest(b"w%d" % i) % quality.SLOTS].append("w%d" % i)
    pairs = [names[:2] for names in slots.values() if len(names) > 1][:30]
    assert len(pairs) == 30  # words that share a place by hash
    monkeypatch.setattr(quality, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(quality, "BUCKET_KEYS", keys)
    rows = [(i, f"near {a} good {i}. {a} a") for i, (a, _) in enumerate(pairs)]
    rows += [(100 + i, f"FAR {b} bad bad {a}!") for i, (a, b) in enumerate(pairs)] + [(200, ""), (None, "near"), (0, "near")]
    known, contexts = quality._Tokens(), collections.defaultdict(lambda: np.zeros(quality.SIZE, int))
    numbers = [[n for w in text.encode().split() for n in known[w]] for _, text in rows]
    index = quality.index_of(np.array(known.keys, np.uint64)).astype(int)
    for line in numbers:
        for i, number in enumerate(line):
            for j in range(max(0, i - quality.WINDOW), min(len(line), i + quality.WINDOW + 1)):
                contexts[number] += index[line[j]] if j != i else 0
    vector = lambda n: np.hstack([contexts[n] / max(np.linalg.norm(contexts[n]), 1), index[n] / 2])
    expected = [np.mean([vector(n) for n in line], axis=0) if line else np.zeros(2 * quality.SIZE) for line in numbers]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    found = sorted((str(r.id), [round(v, 4) + 0.0 for v in r.x[: 2 * quality.SIZE]]) for r in quality.document_vectors(docs).collect())
    wanted = sorted((str(i), [round(float(v), 4) + 0.0 for v in x]) for (i, _), x in zip(rows, expected))
    assert [i for i, _ in found] == [i for i, _ in wanted]
    assert np.allclose([x for _, x in found], [x for _, x in wanted], atol=2e-4)
    for a, b in pairs:
        one, two = (known[w.encode()][0] for w in (a, b))
        assert one != two and (vector(one) != vector(two)).any()


def test_memory_follows_the_distinct_tokens_of_a_block():
    """Vectors of all occurrences, or wide copies of the sums, are never held at once."""
    texts = [" ".join(f"w{i * j % 200_000}" for j in range(200_000)) for i in (1, 3, 7)]
    batch = pa.record_batch({"id": [0, 1, 2], "text": texts})
    (block,) = quality._blocks(iter([batch]))
    block = block.append_column("block", pa.array([0], pa.int64()))
    peaks = []

    def peak(steps):
        tracemalloc.start()
        found = list(steps)
        peaks.append(tracemalloc.get_traced_memory()[1] / block["distinct"][0].as_py())
        tracemalloc.stop()
        return found

    (sent,) = peak(quality._send(4)(iter([block])))
    answers = [{"kind": "sums", "bucket": r["bucket"], "answer": r["sums"]} for r in sent.to_pylist()]
    (pooled,) = peak(quality._pooled(iter([block.append_column("answers", pa.array([answers]))])))
    assert pooled.num_rows == 3
    assert peaks[0] < 600 and peaks[1] < 1200  # bytes a token; it has 32 sums and 64 numbers of its vectors


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    p = 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))
    y = (rng.random(3000) < p).astype(float)
    network = quality.Network(x[:2000], y[:2000])
    scores = network.scores(x[2000:])
    assert np.abs(scores - p[2000:]).mean() < 0.15
    assert abs(scores.mean() - y[2000:].mean()) < 0.06
    assert (quality.Network(x[:2000], y[:2000]).scores(x[2000:]) == scores).all()
    assert set(quality.Network(x[:5], np.ones(5)).scores(x)) == {1.0}
    assert set(quality.Network(x[:0], y[:0]).scores(x)) == {0.5}


def auc(scores, truth):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    good = truth == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_documents_are_told_apart(spark, folder):
    from lastro.llm.queries import QUERIES

    folder = folder.replace("sf0.001", "sf0.01")
    rows = QUERIES["op10_quality"](spark, folder).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    scores, labels = np.array(held).T
    assert auc(scores, labels) > 0.9


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 9), (None, "some words", 9), (2, "", 9), (3, "x " * 200_000, 9), (3, "x " * 200_000, 9)],
        "doc_id long, text string, score int",
    )
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (3, 1), (99, 0), (None, 1)], "doc_id long, quality int")
    rows = quality.score(docs, labels, F.col("doc_id") > 0).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "3", "3", "None"]
    assert all(0 <= r.score <= 1 for r in rows) and [r.held_out for r in rows if r.doc_id is None] == [True]
    assert {r.score for r in quality.score(docs, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels, F.lit(True)).collect() == []


@pytest.mark.parametrize("word, tokens", [(b"the", 1), (b"The,", 2), (b"THE!!", 3), (b"***", 1), (b"A1", 3), ("É***".encode(), 2)])
def test_tokens_of_words(word, tokens):
    assert len(quality._Tokens()[word]) == tokens
