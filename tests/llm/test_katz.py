import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lastro.llm import katz


def brute(texts, train):
    """Katz with dictionaries; texts are lists of words, None is the end."""
    words, follow = collections.Counter(), collections.defaultdict(collections.Counter)
    for text, learned in zip(texts, train):
        if learned:
            words.update(text)
            for h, w in zip(text, text[1:]):
                follow[h][w] += 1
    tables = [katz.discounts(collections.Counter(words.values())),
              katz.discounts(collections.Counter(c for seen in follow.values() for c in seen.values()))]
    d = lambda n, c: tables[n][c] if c <= katz.DISCOUNTED else c - katz.LARGE
    total = sum(words.values())
    unknown = sum(c - d(0, c) for c in words.values()) / total

    def p(h, w):
        single = d(0, words[w]) / total if words[w] else unknown
        seen = follow.get(h)
        if not seen:
            return single
        size = sum(seen.values())
        if w in seen:
            return d(1, seen[w]) / size
        return (1 - sum(d(1, c) for c in seen.values()) / size) / (1 - sum(p(False, x) for x in seen)) * single

    return [sum(math.log10(p(h, w)) for h, w in zip([False, *text], text)) for text in texts], p, words


def words_of(text):
    return (text or "").encode().lower().split() + [None]


@pytest.mark.parametrize("keys, tokens", [(4000, 9000), (1 << 20, 1 << 20)])
def test_scores_equal_brute_force(spark, folder, keys, tokens, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_KEYS", keys)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", tokens)
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60)
    rows = rows.collect()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in katz.score(docs, F.col("doc_id") % 4 != 1).collect()}
    texts, train = [words_of(r.text) for r in rows], [r.doc_id % 4 != 1 for r in rows]
    scores, p, counts = brute(texts, train)
    tokens, distinct = sum(counts.values()), len(counts)
    for row, words, expected in zip(rows, texts, scores):
        got = found[row.doc_id]
        assert got.score == pytest.approx(expected, rel=1e-9)
        assert got.base_score == pytest.approx(
            sum(math.log10((counts[w] + 0.5) / (tokens + 0.5 * (distinct + 1))) for w in words), rel=1e-9
        )
        assert (got.n_tokens, got.n_known) == (len(words), sum(counts[w] > 0 for w in words))
        assert got.train_tokens == tokens and got.held_out == (row.doc_id % 4 == 1)
    for history in [False, *[w for w, _ in counts.most_common(4) if w is not None]]:
        assert sum(p(history, w) for w in [*counts, "never seen"]) == pytest.approx(1)


def brute_of_order(texts, train, order):
    """The same for n-grams of any length."""
    grams = [collections.Counter() for _ in range(order + 1)]
    follow = [collections.defaultdict(dict) for _ in range(order + 1)]
    for words, learned in zip(texts, train):
        for n in range(1, order + 1):
            for at in range(n - 1, len(words) if learned else 0):
                grams[n][tuple(words[at - n + 1 : at + 1])] += 1
    for n in range(2, order + 1):
        for gram, c in grams[n].items():
            follow[n][gram[:-1]][gram[-1]] = c
    tables = [None] + [katz.discounts(collections.Counter(grams[n].values())) for n in range(1, order + 1)]
    d = lambda n, c: tables[n][c] if c <= katz.DISCOUNTED else c - katz.LARGE
    total = sum(grams[1].values())
    unknown = sum(c - d(1, c) for c in grams[1].values()) / total
    weights = {}

    def weight(h):
        if h not in weights:
            n, seen = len(h) + 1, follow[len(h) + 1][h]
            high = sum(d(n, c) for c in seen.values()) / sum(seen.values())
            weights[h] = (1 - high) / (1 - sum(p((*h[1:], w)) for w in seen))
        return weights[h]

    def p(gram):
        n, h = len(gram), gram[:-1]
        if n == 1:
            return d(1, grams[1][gram]) / total if grams[1][gram] else unknown
        seen = follow[n].get(h)
        if not seen:
            return p(gram[1:])
        return d(n, seen[gram[-1]]) / sum(seen.values()) if gram[-1] in seen else weight(h) * p(gram[1:])

    scores = [sum(math.log10(p(tuple(w[max(0, i - order + 1) : i + 1]))) for i in range(len(w))) for w in texts]
    return scores, p, grams


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_of_any_order_equal_brute_force(spark, folder, order, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_KEYS", 4000)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 3000)
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60).collect()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.score for r in katz.score(docs, F.col("doc_id") % 4 != 1, order=order).collect()}
    texts, train = [words_of(r.text) for r in rows], [r.doc_id % 4 != 1 for r in rows]
    scores, p, grams = brute_of_order(texts, train, order)
    assert [found[r.doc_id] for r in rows] == pytest.approx(scores, rel=1e-9)
    vocabulary = [*grams[1], ("never seen",)]
    for history in [g for g, _ in grams[order - 1].most_common(3) if g[-1] is not None] if order > 1 else [()]:
        assert sum(p((*history, *w)) for w in vocabulary) == pytest.approx(1)


def test_query_scores_trigrams(spark, folder):
    from lastro.llm.queries import QUERIES

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    texts, train = [words_of(r.text) for r in docs], [zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for r in docs]
    found = {r.doc_id: r.score for r in QUERIES["op7_katz"](spark, folder).collect()}
    assert [found[r.doc_id] for r in docs] == pytest.approx(brute_of_order(texts, train, 3)[0], rel=1e-9)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (None, "a b a b", 2), (2, "", 3), (3, "A b " * 30000, 4), (3, "A b " * 30000, 4)],
        "doc_id long, text string, score int",
    )
    rows = katz.score(docs, F.col("doc_id") != 2).collect()
    assert sorted((r.n_tokens, r.held_out) for r in rows) == [(1, False), (1, True), (5, True), (60001, False), (60001, False)]
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    untrained = katz.score(docs, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens, round(r.score, 9), round(r.base_score, 9)) for r in untrained} == {(0, 0, 0.0, 0.0)}
    assert katz.score(docs.limit(0), F.lit(True)).collect() == []


def test_packed_numbers_round_trip():
    for values in ([], [0], [255, 256], [1 << 63, 3, 0]):
        array = np.array(values, np.uint64)
        assert katz._unpacked(katz._packed(array)).tolist() == values
        if values:
            assert katz._unpacked_floats(katz._packed_floats(array / 7)).tolist() == (array / 7).tolist()
            assert katz._unpacked_keys(katz._packed_keys(np.sort(array))).tolist() == sorted(values)


def test_query_beats_its_base_on_held_out_texts(spark, folder):
    from lastro.llm.queries import QUERIES

    rows = QUERIES["op7_katz"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
