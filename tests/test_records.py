import csv
import random

import pytest
from pyspark.sql import functions as F

from lastro.sources import files
from lastro.sources.records import ends_inside, read_records


@pytest.mark.parametrize("line, inside, ends", [
    ("", False, False), ("", True, True), ("a,b", False, False), ('"a', False, True), ('a"', True, False), ('a""b', True, True),
    ('"a""b",c', False, False), ('5" pipe,"x', False, True), ('x" ,"y', True, True), ('x",y', True, False), ('"a","b","', False, True),
])
def test_lines_and_quotes(line, inside, ends):
    assert ends_inside(line, inside) is ends


@pytest.fixture(scope="module")
def delivered(tmp_path_factory):
    """Two files of records with line breaks, commas and quotes in their fields, and the rows they were made of."""
    root, rng, rows = tmp_path_factory.mktemp("csv"), random.Random(3), {}
    for part in ("a", "b"):
        rows[part] = [
            [f"{part}{i}", "".join(rng.choice(['x', 'y', ' ', '\n', '"', ',', 'é']) for _ in range(rng.randrange(1, 30))) + "z", "end"]
            for i in range(3000)
        ]
        with open(root / f"{part}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator="\r\n" if part == "b" else "\n")
            writer.writerows([["id", "text", "last"], *rows[part]])
    return str(root), rows


def test_splits_give_the_rows_of_one_task(spark, delivered):
    root, rows = delivered
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(root).rdd.getNumPartitions() > 20
        found = files.read_csv(spark, root, with_order=True).orderBy(files.INGEST_ORDER).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [[r.id, r.text, r.last] for r in found] == rows["a"] + rows["b"]
    assert [r[files.INGEST_ORDER].row for r in found] == [*range(2, 3002)] * 2
    one_task = spark.read.options(header=True, escape='"', multiLine=True).csv(root).orderBy("id").collect()
    assert [tuple(r)[:3] for r in sorted(found, key=lambda r: r.id)] == [tuple(r) for r in one_task]


def test_blank_lines_open_ends_and_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"te""xt"\n1,"a\n\nb"\n\n  \n2,\n3,5" pipe\n4,"never closed\nto the end')
    found = files.read_csv(spark, str(tmp_path), with_order=True).orderBy(files.INGEST_ORDER).collect()
    assert [(r["id"], r['te"xt']) for r in found][:3] == [("1", "a\n\nb"), ("2", None), ("3", '5" pipe')] and len(found) == 4
    (tmp_path / "b.csv").write_text('te"xt,id\nx,9\n')
    with pytest.raises(Exception, match="header differs"):
        files.read_csv(spark, str(tmp_path)).collect()
    assert read_records(spark, str(tmp_path)).where(F.col("record") == 1).count() == 2
