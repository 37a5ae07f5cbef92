import collections
import zlib

import numpy as np

import corpus_pipeline
from lastro.llm import packing, rules
from lastro.session import stored
from tests.llm.test_exact_dedup import LOWER
from tests.llm.test_mixing import WORD, brute_targets
from tests.llm.test_near_dedup import brute as brute_near
from tests.llm.test_rules import brute as brute_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_against_plain_python(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]
    outputs = {}

    def kept_as(name, stage):
        def run(spark, docs, sf_dir):
            outputs[name] = stored(stage(spark, docs, sf_dir), "test")
            return outputs[name]

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, kept_as(n, f)) for n, f in corpus_pipeline.STAGES])
    whole = corpus_pipeline.run(spark, folder).collect()
    given = {r.doc_id: r for r in docs.collect()}

    docs = outputs["quality_rules"]
    assert docs.columns == COLUMNS
    kept = {r.doc_id: r for r in docs.collect()}
    for i, row in given.items():
        n, _, _, _, repeated = brute_rules(row.text)
        if n < 50 or 2 * repeated > n:
            assert i not in kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(labels.get(i, 1) == 1 for i in kept)

    groups = collections.defaultdict(list)
    for i, row in kept.items():
        groups[(row.text or "").translate(LOWER)].append(i)
    docs = outputs["exact_dedup"]
    single = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == COLUMNS and set(single) == {max(ids) for ids in groups.values()}

    near = brute_near([(i, r.text) for i, r in single.items()])
    docs = outputs["near_dedup"]
    left = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == COLUMNS and set(left) == {i for i, (_, root) in near.items() if root == i}

    sizes = collections.Counter()
    for row in left.values():
        sizes[row.source] += len(WORD.findall(row.text))
    docs = outputs["mixing"]
    mixed, words = docs.collect(), collections.Counter()
    assert docs.columns == COLUMNS
    for row in mixed:
        assert left[row.doc_id] == row
        words[row.source] += len(WORD.findall(row.text))
    for source, goal in brute_targets(sizes).items():
        largest = max(len(WORD.findall(r.text)) for r in left.values() if r.source == source)
        assert abs(words[source] - goal) <= largest / 2 + 0.5

    encode = packing.Encoder(packing.tokenizer_path())
    pieces = collections.Counter()
    for row in mixed:
        ids = np.array(encode(row.text) + [1], "<u4")
        for at in range(0, len(ids), 2048):
            pieces[row.doc_id, at, zlib.crc32(ids[at : at + 2048].tobytes()), len(ids)] += 1
    assert collections.Counter((r.doc_id, r.start, r.ids_crc32, r.doc_tokens) for r in whole) == pieces
    assert len({(r.sequence_id, r.offset) for r in whole}) == len(whole)


def test_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), "test")
        assert docs.count() == 0, name
    assert rules.POLICIES["v1"].mask == 63
