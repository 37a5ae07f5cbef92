import collections
import hashlib

from pyspark.sql import functions as F

from lastro.llm import exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [
    (1, "Same Text"), (2, "same text"), (3, "same  text"), (4, None), (5, ""), (6, "ÉTÉ"), (7, "été"), (8, "ÉtÉ"),
    (9, "x" * 300_000), (10, "X" * 300_000), (None, "SAME text"), (None, "alone"), (2, "same text"), (11, "İ"), (12, "K"), (13, "k"),
]


def brute(rows, pick):
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(LOWER)].append(i)
    found = []
    for i, text in rows:
        plain = (text or "").translate(LOWER)
        ids = [x for x in groups[plain] if x is not None]
        keep = pick(ids) if ids else None
        found.append((str(i), str(keep), len(groups[plain]), i == keep, hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(found)


def marked(df):
    return sorted((str(r[0]), str(r[1]), *r[2:]) for r in df.collect())


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, keep_id string, size int")


def test_groups_keep_the_asked_id(spark):
    docs = docs_of(spark, ROWS)
    assert marked(exact_dedup.mark(docs, keep="largest")) == brute(ROWS, max)
    assert marked(exact_dedup.mark(docs)) == brute(ROWS, min)
    assert exact_dedup.mark(docs.limit(0)).collect() == []


def test_colliding_hashes_do_not_join_different_texts(spark):
    same = lambda text: F.unhex(F.md5(F.lit("one").cast("binary")))
    assert marked(exact_dedup.mark(docs_of(spark, ROWS), keep="largest", hashed=same)) == brute(ROWS, max)


def test_deduplicate_keeps_one_row_of_each_text(spark):
    docs = docs_of(spark, ROWS)
    kept = exact_dedup.deduplicate(docs, keep="largest")
    assert kept.columns == docs.columns
    texts = [(r.text or "").translate(LOWER) for r in kept.collect()]
    assert sorted(texts) == sorted({(t or "").translate(LOWER) for _, t in ROWS})
    assert exact_dedup.deduplicate(docs.limit(0)).collect() == []


def test_hot_copies_are_counted_before_the_shuffle(spark, capsys):
    docs = spark.range(1000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', string(id)) AS text")
    rows = exact_dedup.mark(docs).where("text_sha256 = sha2('hot', 256)").collect()
    assert {(r.keep_id, r.group_size) for r in rows} == {(0, 334)}
