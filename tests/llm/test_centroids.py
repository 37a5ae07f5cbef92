import hashlib
import math
import random

import pytest

from lastro.llm import centroids


def brute(rows, k, rounds, dims, seed=3):
    kept = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    means = [v for _, v in first]
    far = lambda v, m: sum((a - b) ** 2 for a, b in zip(v, m))
    near = lambda v: min((far(v, m), c) for c, m in enumerate(means))[::-1]
    for _ in range(rounds):
        found = [near(v)[0] for _, v in kept]
        for c in range(len(means)):
            own = [v for (_, v), f in zip(kept, found) if f == c]
            if own:
                means[c] = [sum(x) // len(own) for x in zip(*own)]
    found = [near(v) for _, v in kept]
    by = [sum(d for c, d in found if c == x) for x in range(len(means))]
    digests = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return sorted(((i, c, d, by[c], sum(by), digests[c]) for (i, _), (c, d) in zip(kept, found)), key=str)


def clustered(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, chunk string")
    return sorted((tuple(r) for r in centroids.cluster(df.repartition(3), **more).collect()), key=str)


def some(seed, dims, n=300):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [rng.gauss(m, 0.2) for m in rng.choice(middles)]) for i in range(n)]
    same = rows[7][1]
    rows += [(1000 + i, same) for i in range(20)] + [(7, same), (7, same), (None, rows[3][1])]
    rows += [(2000, None), (2001, []), (2002, same[:-1]), (2003, [None] + same[1:]), (2004, [math.nan] + same[1:])]
    return rows + [(2005, [-math.inf] + same[1:]), (2006, same + [0.0]), (2007, [-0.0] * dims), (2008, [40.0] * dims)]


@pytest.mark.parametrize("dims,k,shards,chunk", [(7, 5, 3, 16), (64, 8, 4, 4096), (3, 300, 9, 50), (1, 2, 1, 7)])
def test_against_plain_lloyd(spark, monkeypatch, dims, k, shards, chunk):
    monkeypatch.setattr(centroids, "CHUNK", chunk)
    rows = some(dims, dims)
    assert clustered(spark, rows, k=k, rounds=3, dims=dims, shards=shards) == brute(rows, k, 3, dims)


def test_ties_empty_clusters_and_few_vectors(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(6)]
    assert clustered(spark, rows, k=4, rounds=2, dims=2) == brute(rows, 4, 2, 2)
    assert clustered(spark, rows[:2], k=4, rounds=2, dims=2) == brute(rows[:2], 4, 2, 2)
    assert clustered(spark, [(1, [1.0])], dims=2) == [] and clustered(spark, [], dims=2) == []


def test_components_beyond_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        clustered(spark, [(1, [1e9, 0.0]), (2, [0.0, 0.0])], dims=2)


def test_rounds_leave_nothing_cached(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    usable = sum(len(r.embedding) == 64 and all(math.isfinite(x) for x in r.embedding) for r in vectors.collect())
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert centroids.cluster(vectors, rounds=1).count() == usable
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
