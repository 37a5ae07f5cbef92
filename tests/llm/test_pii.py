import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lastro.llm import pii

# The patterns as they are asked for, for Python's engine.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_of(text):
    found = [
        (m.start(), pii.KINDS.index(kind), m.end())
        for kind, pattern in PLAIN.items() for m in re.finditer(pattern, text or "") if valid(kind, m.group())
    ]
    return sorted(found)


TEXTS = [
    None, "", "no data", "a@b.c", "x a.b+c@mail1.example.com, y@z y@z.de.", "a@b.cd_e@f.gh@i.jk", "@a.b c@", "é😀 ü@x.org a@b.c",
    "1.2.3.4.5.6.7.8", "300.1.1.1 and 255.255.255.255", "001.02.3.4", "1.2.3 1..2.3.4", "4111 1111 1111 1111 x",
    "4111-1111-1111-1112", "4111111111111111 4111111111111111", "id 12345678901234567890123", "+1 (988) 555-2485 of",
    "+12 34 +99 1234567890123456", "+1.2.3.4.5.6.7.8.9 tail-", "٤٥ １.2.3.4", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
    "a" * 3000 + "@" + "b" * 3000, "1" * 4000, "mail\nx@y.z\n\n42.144.35.254\t",
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, base string, loose int")
    return {r.doc_id: r for r in pii.find(docs).collect()}


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_base_spans(found, i):
    assert [(c.s, c.k, c.e) for c in found[i].base] == base_of(TEXTS[i])
    assert set(map(tuple, found[i].base)) <= set(map(tuple, found[i].spans))


def test_given_documents(spark, folder):
    from lastro.llm.queries import QUERIES

    texts = dict(map(tuple, spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op4_pii"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = base_of(texts[row.doc_id])
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert row.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(line.split(",")) <= set(row.spans.split(","))


def test_votes_add_loose_spans_with_support_only(spark):
    good = [f"write an e-mail to user{i} (at) mail{i} dot com please" for i in range(20)]
    good += [f"please call phone ({i + 200}) 555-{i + 1000} now" for i in range(20)]
    plain = [f"user{i}@mail.example.com wrote and +1 (2{i:02d}) 555-1234 answered" for i in range(50)]
    clean = [f"we met at noon and order {i}23-456-7890 was version 1.2 at 10.5" for i in range(20)]
    texts = good + plain + clean
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    assert all(len(rows[i].spans) == 1 and not rows[i].base for i in range(20))
    assert all(len(rows[i].base) == 2 for i in range(40, 90))
    assert all(not rows[i].spans for i in range(90, 110))


def test_reliabilities_and_classifier_agree_with_clear_votes():
    counts = [(0, (1, 1, 1, 1), 50), (0, (0, 0, 0, 0), 50), (3, (0, 1, 1, 1), 9), (3, (0, 0, -1, 0), 9), (3, (1, 1, -1, 1), 90)]
    posterior = pii.reliabilities(counts)
    assert posterior[0] > 0.9 > 0.1 > posterior[1] and posterior[4] > 0.9 and posterior[3] < 0.1
    seen = (1, 1, 2)
    weights = pii.train([(k, v, seen, n) for k, v, n in counts], posterior)
    score = [sum(w * f for w, f in zip(weights, pii.features(k, v, seen))) for k, v, _ in counts]
    assert score[0] > 0 > score[1] and score[4] > 0 > score[3]
    assert pii.train([], []) and pii.reliabilities([]) == []


def test_classifier_sees_what_no_labeler_does():
    """Spans with one and the same doubtful vote: those that look like sure ones are taken, others are not."""
    long, short, doubtful = (3, 0, 2), (0, 2, 1), (0, 1, 1, 0)
    patterns = [(0, (1, 1, 1, 1), long, 900), (0, (0, 0, 0, 0), short, 900), (0, doubtful, long, 40), (0, doubtful, short, 40)]
    weights = pii.fit(patterns)
    score = {(v, f): sum(w * x for w, x in zip(weights, pii.features(0, v, f))) for _, v, f, _ in patterns}
    assert score[doubtful, long] > 0 > score[doubtful, short]


def test_many_spans_in_one_text(spark):
    """Time grows with the number of spans, not with its square."""
    import time

    text = " ".join(f"10.0.{i // 250 % 250}.{i % 250} u{i}@mail.example.com" for i in range(50_000)) + " +49 (0) 301 234-567"
    docs = spark.createDataFrame([(1, text), (2, text + " call (212) 555-1234")], "doc_id long, text string")
    start = time.monotonic()
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    assert time.monotonic() - start < 120
    assert [(c.s, c.k, c.e) for c in rows[1].base] == [(s, k, e) for s, k, e in base_of(text)] and len(rows[1].base) == 100_001


def test_no_python_in_the_plan(spark, folder, capsys):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pii.candidates(docs).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.find(docs.where(F.lit(False))).collect() == []
