import re

import pytest

from lastro.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1}
    covered = {i + j for i, w in enumerate(windows) if w in many for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    None, "", " \t\n", "one", "a b", "a b c", "a b c a b c", "a a a a", "a a a", "a b c d a b c", "# * $ % & | < > é#",
    "x y\nx y\n\n \nx y\n z", " lead\x0btrail\x0c ", "line\r\nline\r\n", "é😀 ü ", " nb sp", "w " * 30_000,
    " ".join(f"w{i}" for i in range(60)), "A B C\na b c",
]


def test_measures_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words string")
    for row in rules.ledger(docs).collect():
        m = row._m
        if row._row.doc_id == TEXTS.index("w " * 30_000):
            assert (m.n_words, m.n_repeat_words) == (30_000, 30_000)
            continue
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute(TEXTS[row._row.doc_id])


def test_given_documents(spark, folder):
    from lastro.llm.queries import QUERIES

    docs = spark.read.parquet(f"{folder}/documents.parquet").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "left")
    given = {r.doc_id: r for r in docs.collect()}
    for row in QUERIES["op9_quality_rules"](spark, folder).collect():
        measured = brute(given[row.doc_id].text)
        assert tuple(row[1:6]) == measured
        assert row.base_failed == (measured[0] < 50 or 100 * measured[4] > 50 * measured[0])
        if given[row.doc_id].quality is not None:
            assert row.kept == (bool(given[row.doc_id].quality) and not row.base_failed)


@pytest.mark.parametrize("version", list(rules.POLICIES))
def test_policies_and_ablations(spark, folder, version):
    docs, policy = spark.read.parquet(f"{folder}/documents.parquet"), rules.POLICIES[version]
    ledger = rules.ledger(docs).cache()
    bits = [r._bits for r in ledger.select("_bits").collect()]
    assert rules.apply_policy(docs, policy).count() == sum(b & policy.mask == 0 for b in bits)
    found = {r.rule: r for r in rules.ablations(ledger, policy).collect()}
    assert set(found) == set(policy.rules)
    for bit, name in enumerate(rules.RULES):
        if name in policy.rules:
            own = 1 << bit
            assert tuple(found[name][1:]) == (
                sum(b & own != 0 for b in bits), sum(b & policy.mask == own for b in bits),
                sum(b & (policy.mask ^ own) == 0 for b in bits),
            )
    ledger.unpersist()


def test_kept_rows_have_their_own_columns(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(None, text, "a"), (1, text, None), (1, text, None), (2, None, "b")], "doc_id long, text string, _bits string")
    kept = rules.apply_policy(docs, rules.POLICIES["v1"])
    assert kept.columns == docs.columns and kept.count() == 3
    assert rules.apply_policy(docs.limit(0), rules.POLICIES["v1"]).collect() == []


def test_no_python_and_no_shuffle(spark, folder, capsys):
    rules.ledger(spark.read.parquet(f"{folder}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Exchange" not in plan
