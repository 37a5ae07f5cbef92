import random

import numpy as np
import pytest

from lastro.llm import components, near_dedup


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.cluster(docs).collect()}
    assert found == brute(rows)


def variants(seed, count, words, changed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    for _ in range(count):
        copy = list(base)
        for _ in range(changed):
            copy[rng.randrange(words)] = f"x{rng.randrange(9000)}"
        yield " ".join(copy)


def test_given_documents(spark, folder):
    check(spark, [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()])


@pytest.mark.parametrize("changed", [1, 2, 3])
def test_chains_of_variants(spark, changed):
    texts = [t for seed in range(6) for t in variants(seed, 25, 90, changed)]
    texts += ["one", "one", "One two", "one two three four", "  ", "", None, "a b c d e", "A B c d e"]
    check(spark, list(enumerate(texts)))


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    texts = [t for seed in range(3) for t in variants(seed, 40, 90, 3)]
    check(spark, list(enumerate(texts)))


def test_odd_rows(spark):
    text = "The quick brown fox jumps over the lazy dog"
    docs = spark.createDataFrame(
        [(5, text, "a"), (5, text, "b"), (None, text, "c"), (7, text.upper(), None), (8, None, "e"), (9, "z " * 50000, "f")],
        "doc_id long, text string, component_id string",
    )
    rows = near_dedup.cluster(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in rows) == [
        ("5", 5, "5", True), ("5", 5, "5", True), ("7", 5, "5", False), ("8", 0, "8", True), ("9", 1, "9", True),
        ("None", 5, "None", True),
    ]
    assert near_dedup.deduplicate(docs).columns == docs.columns
    assert near_dedup.deduplicate(docs).count() == 5
    assert near_dedup.cluster(docs.limit(0)).collect() == []


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 199)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert found == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 199: 199, 200: 199}


def test_keys_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(200):
        both = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
        rest = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        sets += [np.unique(np.append(both, rest[:100])), np.unique(np.append(both, rest[100:]))]
    keys, codes = near_dedup.min_hash_keys(sets), near_dedup.min_hash_bytes(sets)
    assert abs((codes[0::2] == codes[1::2]).mean() - 0.75) < 0.02
    agree = (keys[0::2] == keys[1::2]).mean()
    assert abs(agree - 0.75**3) < 0.02
    assert len(np.unique(keys)) > 0.5 * keys.size
