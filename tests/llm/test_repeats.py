import collections
import random

import numpy as np
import pytest

from lastro.llm import repeats


def brute(texts, length):
    """Removed runs of each text, by counting every window."""
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    found = []
    for d in data:
        removed = np.zeros(len(d) + 2, bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                removed[p + 1 : p + length + 1] = True
        edges = np.flatnonzero(removed[1:] != removed[:-1]).tolist()
        kept = bytes(np.frombuffer(d, np.uint8)[~removed[1:-1]])
        found.append((len(d), edges[::2], edges[1::2], kept))
    return found


def removed(spark, texts, length, partitions=3):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, spans int").repartition(partitions)
    return [tuple(r)[1:4] + (bytes(r.kept),) for r in repeats.remove_repeats(docs, length).orderBy("doc_id").collect()]


def some_texts(seed, n=60):
    rng = random.Random(seed)
    letters = lambda k: "".join(rng.choice("abcdefghij klé\n") for _ in range(k))
    passages = [letters(rng.choice([30, 45, 80, 300])) for _ in range(6)]
    texts = [None, "", "a" * 400, "a" * 39, "ab" * 150, "xyz" * 100 + letters(20), passages[3], letters(3000)]
    for _ in range(n):
        parts = [letters(rng.randrange(0, 90)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            parts.insert(rng.randrange(len(parts) + 1), p if rng.random() < 0.5 else p[cut:] if rng.random() < 0.5 else p[:cut])
        texts.append("".join(parts))
    return texts + [texts[10], texts[11], texts[11]]


@pytest.mark.parametrize("length", [40, 41, 7, 1])
def test_against_every_window(spark, length):
    texts = some_texts(length)
    assert removed(spark, texts, length) == brute(texts, length)


def test_segments_of_a_long_text(spark, monkeypatch):
    texts = some_texts(5, 30)
    plain = brute(texts, 40)
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    anchors = repeats._find_anchors(40, 27)
    rows = []
    import pyarrow as pa

    data = [(t or "").encode() for t in texts]
    for batch in anchors([pa.record_batch({"id": list(range(len(data))), "key": data, "data": data})]):
        rows += batch.to_pylist()
    # Every window belongs to exactly one anchor, or to a run that the text itself repeats.
    for d, row, (_, starts, ends, _) in zip(data, rows, plain):
        windows = collections.Counter()
        for at, lo, hi in zip(row["at"], row["lo"], row["hi"]):
            windows.update(range(at - hi, at - lo + 1))
        inside = set()
        for s, e in zip(row["starts"], row["ends"]):
            inside |= set(range(s, e - 39))
            assert any(a <= s and e <= b for a, b in zip(starts, ends))
        assert set(windows) | inside == set(range(len(d) - 39)) and set(windows.values()) <= {1}


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(500))
    rows = [(None, text), (None, text), (1, text), (1, text), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.remove_repeats(docs).select("doc_id", "n_bytes", "starts", "ends").collect()
    assert sorted(map(str, found)) == sorted(
        [f"Row(doc_id={i}, n_bytes=500, starts=[0], ends=[500])" for i in (None, None, 1, 1)]
        + ["Row(doc_id=2, n_bytes=0, starts=[], ends=[])"]
    )
    assert repeats.remove_repeats(docs.limit(0)).collect() == []


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id")
    rows = docs.select("doc_id", "text").collect()
    found = repeats.remove_repeats(docs).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.starts, r.ends, bytes(r.kept)) for r in found] == brute([r.text for r in rows], 400)
    assert sum(len(r.starts) for r in found) > 0
