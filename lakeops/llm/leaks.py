"""Benchmark passages inside documents, by greedy string tiling.

Shared seeds, runs of ``min_match`` tokens found by a rolling hash, join documents with test items. For
each joined pair the longest common runs of tokens are marked first, then the longest among what is
unmarked, until none reaches ``min_match``. An item is leaked into a document when the tiles cover a
given share of its tokens, in whatever order they stand.

The items go to the tasks in blocks of a bounded size, so the documents stay where they are read and
no document or item is left out at any size of either.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.llm.common import query, table

TOKENS = re.compile(r"\w+").findall
BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    return TOKENS(text.lower()) if text else []


def _rolled(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash of every run of n ids, modulo 2^64."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for i in range(n):
        out = out * BASE + ids[i : i + len(out)]
    return out


def tiles(item: np.ndarray, doc: np.ndarray, seeds: list[tuple[int, int]], min_match: int) -> list[tuple[int, int, int]]:
    """(item start, document start, length) of the tiles, longest first, ties by position.

    ``seeds``: positions where ``min_match`` tokens agree. Seeds in a row on one diagonal are one match;
    a match that lost tokens to a longer tile is cut to its unmarked runs and tried again.
    """
    matches = []
    by_diagonal = defaultdict(list)
    for i, j in seeds:
        by_diagonal[j - i].append(i)
    for diagonal, starts in by_diagonal.items():
        starts.sort()
        first = last = starts[0]
        for i in [*starts[1:], None]:
            if i != last + 1 if i is not None else True:
                matches.append((-(last - first + min_match), first, first + diagonal))
                first = i
            last = i
    heapq.heapify(matches)
    marked_item, marked_doc, out = np.zeros(len(item), bool), {}, []
    while matches:
        size, i, j = heapq.heappop(matches)
        size = -size
        free = [not marked_item[i + k] and j + k not in marked_doc for k in range(size)]
        if all(free):
            out.append((i, j, size))
            marked_item[i : i + size] = True
            marked_doc.update((j + k, None) for k in range(size))
            continue
        start = None
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= min_match:
                    heapq.heappush(matches, (-(k - start), i + start, j + start))
                start = None
    return out


class Items:
    """A block of test items: their words as integers, and their seeds sorted for the join."""

    def __init__(self, rows: list[tuple[int, str | None]], min_match: int):
        self.min_match, self.words, self.items = min_match, {}, []
        for number, text in rows:
            ids = [self.words.setdefault(word, len(self.words) + 1) for word in tokens(text)]
            self.items.append((number, np.array(ids, np.uint64)))
        hashes = [_rolled(ids, min_match) for _, ids in self.items]
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else owner
        joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        self.seeds, self.owner, self.place = joined[order], owner[order], place[order]

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """(text, item, tiles) of the pairs that share a seed."""
        get, n = self.words.get, self.min_match
        ids = [np.array([get(word, 0) for word in tokens(text)], np.uint64) for text in texts]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint64)
        text_of = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        starts = np.cumsum([0, *(len(x) for x in ids)])
        rolled = _rolled(flat, n)
        if not len(rolled) or not len(self.seeds):
            return
        known = np.concatenate([[0], np.cumsum(flat > 0)])
        inside = (known[n:] - known[:-n] == n) & (text_of[: len(rolled)] == text_of[n - 1 :])
        at = np.flatnonzero(inside)
        low = np.searchsorted(self.seeds, rolled[at], "left")
        high = np.searchsorted(self.seeds, rolled[at], "right")
        pairs = defaultdict(list)
        for j, a, b in zip(*(x[high > low].tolist() for x in (at, low, high)), strict=True):
            text = int(text_of[j])
            for s in range(a, b):
                item, i = int(self.owner[s]), int(self.place[s])
                if np.array_equal(self.items[item][1][i : i + n], flat[j : j + n]):
                    pairs[text, item].append((i, j - int(starts[text])))
        for (text, item), seeds in pairs.items():
            yield text, item, tiles(self.items[item][1], ids[text], seeds, n)


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_key: str = "item_id",
    min_match: int = 4,
    min_coverage: float = 0.6,
    block_chars: int = 8_000_000,
) -> DataFrame:
    """(key, item_id, n_tokens, n_covered, n_tiles, coverage) of the pairs with ``min_coverage``.

    Tokens are runs of word characters in lower case, so case, punctuation and white space don't
    count. Items with fewer than ``min_match`` tokens have no tile and match nothing, like null and empty
    texts. Rows that repeat a key give a row each. ``block_chars`` bounds the items sent at once.
    """
    columns = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField(item_key, items.schema[item_key].dataType),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_covered", T.LongType()),
        T.StructField("n_tiles", T.LongType()), T.StructField("coverage", T.DoubleType()),
    ])
    spark = docs.sparkSession
    given = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    wanted = items.select(items[item_key].alias("item"), items["text"].alias("text"))
    size = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = size // block_chars + 1
    out = None
    for block in range(blocks):
        part = wanted.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        index = spark.sparkContext.broadcast(Items([tuple(row) for row in part.collect()], min_match))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            block = index.value
            for batch in batches:
                for start in range(0, batch.num_rows, 500):
                    piece = batch.slice(start, 500)
                    rows = []
                    for at, item, found in block.find(piece.column("text").to_pylist()):
                        number, ids = block.items[item]
                        covered = sum(size for _, _, size in found)
                        if covered >= min_coverage * len(ids):
                            rows.append((at, number, len(ids), covered, len(found), covered / len(ids)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column("key").take(pa.array([r[0] for r in rows], pa.int64())),
                            *(pa.array([r[i] for r in rows]).cast(kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()), 1)),
                        ],
                        names=columns.names,
                    )

        found = given.mapInArrow(run, columns)
        out = found if out is None else out.unionAll(found)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows into which no item is leaked, with all their columns; rows with a null key go by their own text."""
    raw = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    marked = docs.withColumn("_leak_key", F.struct(docs[key].cast("long").alias("id"), raw.alias("raw")))
    found = leaked_items(marked, items, key="_leak_key").select(F.col("_leak_key.id").alias("_found"), F.col("_leak_key.raw").alias("_found_raw")).distinct()
    same = marked["_leak_key"]["id"].eqNullSafe(found["_found"]) & (marked["_leak_key"]["raw"] == found["_found_raw"])
    return marked.join(found, same, "left_anti").drop("_leak_key")


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
