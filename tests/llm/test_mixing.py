import collections
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from lastro.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Reshare the excess until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        goal = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if goal[s] > cap * sizes[s]]
        if not over:
            return capped | goal
        capped |= {s: cap * sizes[s] for s in over}


def check_plan(rows, texts, **settings):
    sizes = collections.Counter()
    for _, text, source in texts:
        sizes[source] += len(WORD.findall(text or ""))
    goals = brute_targets(sizes, **settings)
    taken = collections.Counter()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.source_size == sizes[row.source] and row.target == pytest.approx(goals[row.source], rel=1e-9)
        assert row.taken in (0, row.size, 2 * row.size) and all(d.words == row.size for d in row.draws)
        assert row.taken == sum(d.words for d in row.draws)
        taken[row.source] += row.taken
    return goals, taken


def check_near(texts, goals, taken):
    """Half of the largest document of a source, at most, lies between the words taken and the target."""
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= max(len(WORD.findall(t or "")) for _, t, s in texts if s == source) / 2 + 0.5


TEXTS = [
    (i, "w " * (i * 37 % 91 + (5000 if i == 7 else 0)), s)
    for i, s in enumerate(["a", "b", "c", "d", None, "Z", "é", ""] * 30)
] + [(900, None, "a"), (901, "", None), (None, "x y z", "b"), (None, None, None), (902, "", "only empty")]


def test_targets_and_taken_words(spark):
    docs = spark.createDataFrame([(*t, 1) for t in TEXTS], "doc_id long, text string, source string, size int")
    rows = mixing.plan(docs).collect()
    check_near(TEXTS, *check_plan(rows, TEXTS))
    again = mixing.plan(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mixing.plan(docs.limit(0)).collect() == []


def test_one_source_and_repeated_rows(spark):
    texts = [(1, "a b c d", "s")] * 3 + [(2, "e f g", "s")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    goals, taken = check_plan(mixing.plan(docs).collect(), texts)
    assert abs(taken["s"] - goals["s"]) <= 8
    mixed = mixing.mix(docs).collect()
    assert sum(len(WORD.findall(r.text)) for r in mixed) == taken["s"]


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 40), min_size=1), st.sampled_from([1, 2, 4, 8]))
def test_the_tree_splits_quotas_exactly(spark, quotas, shards):
    rows = mixing.split_tree(spark.createDataFrame(list(quotas.items()), "source string, quota long"), shards).collect()
    by_source, by_shard = collections.Counter(), collections.Counter()
    for row in rows:
        by_source[row.source] += row.quota
        by_shard[row.shard] += row.quota
    assert by_source == collections.Counter({s: n for s, n in quotas.items() if n})
    if sum(quotas.values()) >= shards:
        assert max(by_shard.values()) - min(by_shard[s] for s in range(shards)) <= 3


def test_the_tree_draws_in_proportion(spark):
    counts = collections.Counter()
    for seed in range(12):
        rows = mixing.split_tree(spark.createDataFrame([("a", 30), ("b", 10)], "source string, quota long"), 2, seed).collect()
        counts.update({(r.source, r.shard): r.quota for r in rows})
    # Hypergeometric: mean 15 and 5, standard deviation 1.39 for one draw, 0.4 for the mean of 12.
    assert abs(counts["a", 0] / 12 - 15) < 1.6 and abs(counts["b", 1] / 12 - 5) < 1.6


def test_blocks_shards_and_rows_of_the_mix(spark, folder, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_BLOCK_WORDS", 500)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = mixing.plan(docs, shards=4).collect()
    texts = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    goals, taken = check_plan(rows, texts)
    check_near(texts, goals, taken)
    shards = collections.Counter(d.shard for r in rows for d in r.draws)
    assert set(shards) == {0, 1, 2, 3}
    for row in rows:
        assert [d["pass"] for d in row.draws] == list(range(1, len(row.draws) + 1))
    mixed = mixing.mix(docs, shards=4)
    assert mixed.columns == docs.columns
    given = {i: t for i, t, _ in texts}
    words = collections.Counter()
    for row in mixed.collect():
        assert given[row.doc_id] == row.text
        words[row.source] += len(WORD.findall(row.text))
    assert words == taken
    # Within a partition rows of a shard lie in drawn order.
    places = collections.defaultdict(list)
    for row in rows:
        for draw in row.draws:
            places[row.doc_id].append((draw.shard, draw.position))
    parts = mixed.select("doc_id", F.spark_partition_id().alias("p")).collect()
    for part in {r.p for r in parts}:
        least = (-1, 0)
        for doc_id in (r.doc_id for r in parts if r.p == part):
            least = min(x for x in places[doc_id] if x > least)


def test_bad_number_of_shards(spark):
    with pytest.raises(ValueError):
        mixing.split_tree(spark.createDataFrame([("a", 1)], "source string, quota long"), 3)
