import collections
import math
import random
import re

import numpy as np
import pytest

from lastro.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counted = [(i, collections.Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    frequency = collections.Counter(t for _, c, _ in counted for t in c)
    asked = collections.defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms_of(text))
    found = []
    for item, terms in asked.items():
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1))) for t in terms if frequency[t]}
        scores = []
        for i, c, n in counted:
            m = 100 - 90 + 90 * n * n_docs // total
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                scores.append((-score, i is None, i if i is not None else 0, i))
        found += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=str)


def searched(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, item string").repartition(3)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in ranked.search(d, q, **more).collect()), key=str)


def some(seed, n_docs=400, n_items=25):
    rng = random.Random(seed)
    words = [f"{'Wé'[i % 2]}{i}" for i in range(120)]
    draw = lambda k: " ".join(words[min(int(rng.expovariate(0.06)), 119)] for _ in range(k))
    docs = [(i, draw(rng.randrange(0, 40)).replace(" ", rng.choice([" ", ", ", "\n-"]))) for i in range(n_docs)]
    docs += [(1000, None), (1001, ""), (1002, "... !"), (None, docs[3][1]), (None, docs[3][1]), (3, docs[3][1]), (1003, draw(20_000))]
    docs += [(2000 + i, docs[5][1]) for i in range(30)]
    items = [(i, draw(rng.randrange(1, 30))) for i in range(n_items)]
    items += [(50, None), (51, " - "), (52, "nowhere at all"), (None, docs[3][1]), (53, docs[5][1]), (53, docs[5][1]), (53, "w1"), (54, docs[5][1].upper())]
    return docs, items


@pytest.mark.parametrize("postings", [40, 1 << 19])
def test_against_scores_of_all(spark, monkeypatch, postings):
    monkeypatch.setattr(ranked, "POSTINGS", postings)
    docs, items = some(1)
    assert searched(spark, docs, items) == brute(docs, items)
    assert searched(spark, docs, items, k=3) == brute(docs, items, 3)


def test_rounds_of_items(spark, monkeypatch):
    monkeypatch.setattr(ranked, "ROUND_TERMS", 100)
    docs, items = some(2, 100)
    assert searched(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = some(3, 8, 2)
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == [] and searched(spark, [(1, None)], items) == []


def test_accumulators_are_limited_and_results_stay_exact():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    docs = [(i, b" ".join(b"t%d" % t for t in np.unique(np.minimum(rng.exponential(6, 60).astype(int), 39)))) for i in range(3000)]
    docs = [(i, t + b" rare" * (i % 500 == 7)) for i, t in docs]
    numbers = {b"t%d" % t: t for t in range(40)} | {b"rare": 40}
    batch = pa.record_batch({"id": [i for i, _ in docs], "data": [t for _, t in docs]})
    (rows,) = list(ranked._index(numbers)(iter([batch])))
    block = ranked.Block.read(rows, 3000, rows.column("total")[0].as_py())
    wanted = [(40, 6000), (39, 3000), *((t, 400 - 10 * t) for t in range(20, 0, -1))]
    docs_, scores = block.best(wanted, 6)
    every = np.zeros(3000, np.int64)
    for t, w in wanted:
        if t in block.terms:
            span = slice(block.bounds[block.terms[t]], block.bounds[block.terms[t] + 1])
            every[block.docs[span]] += w * block.parts[span]
    order = np.lexsort((block.by_id, -every))[:6]
    assert docs_.tolist() == order.tolist() and scores.tolist() == every[order].tolist()
    # With the six rare documents found, later terms read only what lies at them.
    assert block.best(wanted, 6, int(scores[-1]))[0].tolist() == order.tolist()
    assert block.best(wanted, 6, int(scores[0]) + 1)[0].tolist() == []
