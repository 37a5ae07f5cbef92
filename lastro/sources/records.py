"""CSV files whose fields hold line breaks, read by many tasks.

A file is read as lines, in the splits that Spark makes of it.  Whether a split begins inside a quoted field is not known
to the task that reads it, so a first pass finds, for both answers, how the split ends and how many records begin in it.
Put together in the order of the splits of each file this says how each begins.  The second pass marks, in every split
from its true beginning, the lines at which records begin.  A line that is a record goes on as it is; only lines of
records with line breaks are brought together, by the number of their record in the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPLITS = "file string, block bigint, outside boolean, records bigint, outside_in boolean, records_in bigint"
_LINES = "file string, record bigint, line bigint, text string, whole boolean"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside (or outside) a quoted field ends inside one.

    A quote opens a field only as its first character; doubled quotes in a quoted field are characters.
    """
    at = 0
    while True:
        if inside:
            found = line.find('"', at)
            if found < 0:
                return True
            if line.startswith('"', found + 1):
                at = found + 2
                continue
            at, inside = found + 1, False
        elif line.startswith('"', at):
            at, inside = at + 1, True
            continue
        comma = line.find(",", at)
        if comma < 0:
            return False
        at = comma + 1


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Stretches of rows of one split: (file, block), first row, one past the last."""
    files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    start = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or blocks[i] != blocks[start] or files[i] != files[start]:
            yield (files[start], blocks[start]), start, i
            start = i


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines -> for each split, from both beginnings: whether it ends inside a field, and the records begun in it."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        texts = batch.column(2).to_pylist()
        for split, start, stop in _runs(batch):
            state = found.setdefault(split, [False, 0, True, 0])
            for text in texts[start:stop]:
                for side in (0, 2):
                    state[side + 1] += not state[side]
                    if '"' in text:
                        state[side] = ends_inside(text, state[side])
    rows = [(*split, *state) for split, state in found.items()]
    yield pa.record_batch(
        list(map(list, zip(*rows))) if rows else [[]] * 6,
        schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("outside", pa.bool_()), ("records", pa.int64()),
                          ("outside_in", pa.bool_()), ("records_in", pa.int64())]),
    )


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with the beginning of their split -> lines with the number of their record in the file."""
    split, inside, record, line = None, False, 0, 0
    for batch in batches:
        texts, begins, befores = (batch.column(c).to_pylist() for c in (2, 3, 4))
        records, lines, whole = [], [], []
        for own, start, stop in _runs(batch):
            if own != split:
                split, inside, record, line = own, begins[start], befores[start], 0
            for text in texts[start:stop]:
                begun = not inside
                record += begun
                if '"' in text:
                    inside = ends_inside(text, inside)
                records.append(record)
                lines.append((split[1] << 20) + line)
                whole.append(begun and not inside)
                line += 1
        yield pa.record_batch({
            "file": batch.column(0), "record": pa.array(records, pa.int64()), "line": pa.array(lines, pa.int64()),
            "text": batch.column(2), "whole": pa.array(whole, pa.bool_()),
        })


def _beginnings(surveyed: DataFrame) -> DataFrame:
    """``file, block, inside, before``: how each split begins, and the number of records begun before it."""
    listed = surveyed.groupBy("file").agg(F.sort_array(F.collect_list(
        F.struct("block", "outside", "records", "outside_in", "records_in")
    )).alias("splits"))
    put_together = (
        "aggregate(splits, named_struct('inside', false, 'before', 0L, 'out',"
        " cast(array() AS array<struct<block: bigint, inside: boolean, before: bigint>>)), (a, s) -> named_struct("
        "'inside', if(a.inside, s.outside_in, s.outside), 'before', a.before + if(a.inside, s.records_in, s.records),"
        " 'out', array_append(a.out, named_struct('block', s.block, 'inside', a.inside, 'before', a.before))), a -> a.out)"
    )
    return listed.select(F.col("file").alias("file_"), F.explode(F.expr(put_together)).alias("b")).select(
        "file_", F.col("b.block").alias("block_"), "b.inside", "b.before"
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``record`` (its number in the file, from 1) and ``text`` of every record; blank lines outside of
    fields are records of their own.

    The table of splits, one row for as many bytes as ``spark.sql.files.maxPartitionBytes``, is broadcast: 800,000 rows
    of about 100 bytes for 100 TB.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.rtrim(F.col("value"), F.lit("\r")).alias("text"),
    )
    splits = _beginnings(lines.mapInArrow(_survey, _SPLITS))
    begun = lines.join(
        F.broadcast(splits), (F.col("file") == F.col("file_")) & (F.col("block") == F.col("block_")), "left"
    ).select("file", "block", "text", "inside", "before")
    marked = begun.mapInArrow(_mark, _LINES)
    pieces = marked.where("NOT whole").groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("line", "text"))).alias("lines")
    )
    joined = pieces.select("file", "record", F.array_join(F.col("lines.text"), "\n").alias("text"))
    return marked.where("whole").select("file", "record", "text").unionByName(joined)
