"""Ranked lexical search over all documents, term at a time with a limit on accumulators.

Documents are cut into blocks, each a small inverted index of the terms that items ask for, stored in the shared folder.
The figures of the whole corpus (documents, terms, document frequencies) come from the blocks by aggregation; then
every block is searched by itself with them, and the best of all blocks are ranked.

Within a block an item's terms are taken rarest first.  A document gets an accumulator when a term first occurs in it.
What the terms still to come can add to any document is known from their largest contributions in the block; once that
is less than the k-th best partial score (of this block, or of the blocks that the task searched before), no document
without an accumulator can be among the best, so no more are made.  The frequent terms that are left only update
survivors, looked up in their postings.  Survivors that can no longer reach the k-th score are let go.  A document that
could still tie is kept, so the results are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastro.llm.text import text_of
from lastro.session import releasing_shuffles, stored

#: Postings of a block, about; a document is never divided.
POSTINGS = 1 << 19
#: Terms, about, that are looked for at once; more items are searched in several rounds.
ROUND_TERMS = 1 << 19

# Letters, digits and everything beyond ASCII make up terms; A-Z are lower-cased.
_LOWERED = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def split_terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_LOWERED).split()


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(split_terms(t.as_buffer().to_pybytes()))) for t in batch.column(1)]
        rows = np.repeat(np.arange(batch.num_rows), [len(t) for t in terms])
        yield pa.record_batch({
            "item": batch.column(0).take(pa.array(rows)), "term": pa.array([t for x in terms for t in x], pa.binary()),
        })


def _index(numbers: dict[bytes, int]):
    """``id, data`` -> blocks: ids and sizes of documents, postings ordered by term, totals of all documents read."""

    def flush(ids: list, sizes: list, docs: list, terms: list, counts: list, seen: int, total: int) -> pa.RecordBatch:
        term = np.array(terms, np.int64)
        order = np.argsort(term, kind="stable")
        distinct, first = np.unique(term[order], return_index=True)
        lists = {
            "sizes": np.array(sizes, np.int64), "terms": distinct.astype(np.int32),
            "ends": np.append(first[1:], len(term)).astype(np.int32)[: len(distinct)],
            "docs": np.array(docs, np.int32)[order], "counts": np.array(counts, np.int64)[order],
        }
        ids = pa.concat_arrays(ids) if ids else pa.nulls(0, kind[0])
        return pa.record_batch({
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            **{n: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for n, x in lists.items()},
            "documents": pa.array([seen], pa.int64()), "total": pa.array([total], pa.int64()),
        })

    kind: list[pa.DataType] = []

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, docs, terms, counts, seen, total = [], [], [], [], [], 0, 0
        for batch in batches:
            kind[:] = [batch.column(0).type]
            for i, value in enumerate(batch.column(1)):
                found = split_terms(value.as_buffer().to_pybytes())
                if not found:
                    continue
                seen += 1
                total += len(found)
                asked = Counter(filter(numbers.__contains__, found))
                if not asked:
                    continue
                docs += [len(sizes)] * len(asked)
                terms += map(numbers.__getitem__, asked)
                counts += asked.values()
                ids.append(batch.column(0).slice(i, 1))
                sizes.append(len(found))
                if len(docs) >= POSTINGS:
                    yield flush(ids, sizes, docs, terms, counts, seen, total)
                    ids, sizes, docs, terms, counts, seen, total = [], [], [], [], [], 0, 0
        if seen:
            yield flush(ids, sizes, docs, terms, counts, seen, total)

    return index


@dataclass
class Block:
    """Postings of one block, with contributions in place of counts."""

    ids: pa.Array
    by_id: np.ndarray          # place of each document in the order of ids
    terms: dict[int, int]
    bounds: np.ndarray         # first posting of each term, and one end
    docs: np.ndarray
    parts: np.ndarray
    most: np.ndarray           # largest contribution of each term

    @classmethod
    def read(cls, rows: pa.RecordBatch, documents: int, total: int) -> "Block":
        lists = {n: rows.column(n).flatten().to_numpy() for n in ("sizes", "terms", "ends", "docs", "counts")}
        ids = rows.column("ids").flatten()
        by_id = np.empty(len(ids), np.int64)
        by_id[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        length = 10 + 90 * lists["sizes"] * documents // max(total, 1)
        parts = 1_000_000_000 * lists["counts"] // (1000 * lists["counts"] + 8 * length[lists["docs"]])
        bounds = np.append(0, lists["ends"])
        most = np.maximum.reduceat(parts, bounds[:-1]) if len(parts) else np.zeros(0, np.int64)
        return cls(ids, by_id, {t: i for i, t in enumerate(lists["terms"].tolist())}, bounds, lists["docs"], parts, most)

    def best(self, wanted: list[tuple[int, int]], k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best, best first; ``wanted`` are terms with their weights, rarest first.
        Documents below ``floor`` may be missing."""
        found = [(self.terms[t], w) for t, w in wanted if t in self.terms and w > 0]
        ahead = np.append(np.cumsum([int(self.most[t]) * w for t, w in found][::-1])[::-1], 0)
        scores = np.zeros(len(self.by_id), np.int64)
        kth, live = max(floor, 1), None
        for i, (t, w) in enumerate(found):
            span = slice(self.bounds[t], self.bounds[t + 1])
            docs, parts = self.docs[span], self.parts[span]
            if live is None and ahead[i] < kth:
                live = np.flatnonzero(scores)
            if live is None:
                scores[docs] += w * parts
                if len(scores) > k and scores.max() > ahead[i + 1]:
                    kth = max(kth, int(np.partition(scores, -k)[-k]))
                continue
            live = live[scores[live] + ahead[i] >= kth]
            at = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
            hit = docs[at] == live
            scores[live[hit]] += w * parts[at[hit]]
            if len(live) > k:
                kth = max(kth, int(np.partition(scores[live], -k)[-k]))
        live = np.flatnonzero(scores) if live is None else live
        live = live[scores[live] >= kth]
        live = live[np.lexsort((self.by_id[live], -scores[live]))][:k]
        return live, scores[live]


def _search(items: list[list[tuple[int, int]]], documents: int, total: int, k: int):
    """Blocks -> the best documents of a task for every item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, scores = [None] * len(items), [np.zeros(0, np.int64)] * len(items)
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block.read(batch.slice(i, 1), documents, total)
                for number, wanted in enumerate(items):
                    had = scores[number]
                    docs, found = block.best(wanted, k, int(had[-1]) if len(had) == k else 0)
                    if not len(docs):
                        continue
                    named = block.ids.take(pa.array(docs))
                    if len(had):
                        named, found = pa.concat_arrays([ids[number], named]), np.concatenate([had, found])
                    places = np.empty(len(named), np.int64)
                    places[pc.sort_indices(named, null_placement="at_end").to_numpy()] = np.arange(len(named))
                    order = np.lexsort((places, -found))[:k]
                    ids[number], scores[number] = named.take(pa.array(order)), found[order]
        some = [n for n in range(len(items)) if ids[n] is not None]
        if some:
            yield pa.record_batch({
                "number": pa.array(np.repeat(some, [len(scores[n]) for n in some]), pa.int32()),
                "id": pa.concat_arrays([ids[n] for n in some]), "score": pa.array(np.concatenate([scores[n] for n in some])),
            })

    return search


def _round(texts: DataFrame, asked: DataFrame, k: int, id_type: str) -> DataFrame:
    """The best documents of the items in ``asked`` (item, term), whose terms the driver holds."""
    spark = texts.sparkSession
    rows = asked.toArrow()
    terms = sorted(set(rows["term"].to_pylist()))
    numbers = {t: i for i, t in enumerate(terms)}
    layout = (
        f"ids array<{id_type}>, sizes array<bigint>, terms array<int>, ends array<int>, docs array<int>, "
        "counts array<bigint>, documents bigint, total bigint"
    )
    blocks = stored(texts.mapInArrow(_index(numbers), layout), "ranked-blocks")
    documents, total = blocks.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    # Postings of a term in a block: its end less the end before it.
    held = blocks.select("terms", F.expr("transform(ends, (e, i) -> e - if(i = 0, 0, ends[i - 1]))").alias("counts"))
    held = held.select(F.explode(F.map_from_arrays("terms", "counts")).alias("term", "frequency"))
    with releasing_shuffles(spark):
        frequency = {r[0]: r[1] for r in held.groupBy("term").agg(F.sum("frequency")).collect()}
    names, wanted = {}, []
    for item, term in zip(rows["item"].to_pylist(), rows["term"].to_pylist()):
        number = numbers[term]
        at = names.setdefault(item, len(names))
        if at == len(wanted):
            wanted.append([])
        if number in frequency:
            wanted[at].append((number, weight(documents, frequency[number])))
    for found in wanted:
        found.sort(key=lambda x: (frequency[x[0]], x[0]))
    best = blocks.mapInArrow(_search(wanted, documents, total, k), f"number int, id {id_type}, score bigint")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    listed = spark.createDataFrame(
        [(n, item) for item, n in names.items()], f"number int, item {asked.schema['item'].dataType.simpleString()}"
    )
    return ranked.join(listed, "number").select("item", "rank", "id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The ``k`` best documents with a score above 0 of every item: item, ``rank`` from 1, id, ``score``.

    Terms are runs of letters, digits and characters beyond ASCII, with A-Z in lower case.  A document's score adds, over
    the item's distinct terms, weight times contribution: weight floor(1000 ln((2N + 2) / (2df + 1))), contribution
    10^9 tf div (1000 tf + 8m), m = 10 + 90 n N div L.  Equal scores go by id, null ids last.

    Null and empty texts have no terms: such documents count nowhere, such items have no rows.  Rows of items with one
    id are one item with the terms of all; repeated documents are documents of their own, each with a rank.  Empty tables
    give no rows.  Other columns are ignored, whatever their names.

    The driver and every task hold the terms of one round of items and their frequencies, about ``ROUND_TERMS`` of them,
    or those of the largest item; items are dealt to rounds by a hash, and each round reads the documents once.
    """
    spark = docs.sparkSession
    id_type, item_type = (t.simpleString() for t in (docs.schema[id_column].dataType, items.schema[item_column].dataType))
    texts = docs.select(docs[id_column].alias("id"), text_of(docs[text_column]).cast("binary").alias("data"))
    asked = items.select(items[item_column].alias("item"), text_of(items[item_text]).cast("binary").alias("data"))
    asked = stored(asked.mapInArrow(_item_terms, f"item {item_type}, term binary").distinct(), "ranked-terms")
    rounds = asked.count() // ROUND_TERMS + 1
    found = None
    for r in range(rounds):
        part = asked if rounds == 1 else asked.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == r)
        best = _round(texts, part, k, id_type)
        found = best if found is None else found.unionByName(best)
    return found.select(
        F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score"
    )
