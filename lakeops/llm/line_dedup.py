"""Frequent lines out of every document, by levelled sorted runs of line hashes.

A run is a Parquet table of (key, n_docs) sorted by key. Each batch of documents is merge-anti-joined
with the runs of keys already known to be frequent, so those are not counted again, and what is left
is added as a run of its own. When a level holds ``fanout`` runs they are merged into one run of the
next level; keys that reach the threshold move to the frequent runs. Counts are combined before every
shuffle, so a line that a third of all documents hold is a few rows. All DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm.common import BLANKS, ascii_lower, discard, query, stored, table


class LineRuns:
    """Counts of line keys over batches: levelled sorted runs, and runs of the keys at or over the threshold."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.frequent: list[DataFrame] = []

    def _run(self, counts: DataFrame, label: str) -> DataFrame:
        return stored(counts.sortWithinPartitions("key"), label)

    def _place(self, run: DataFrame, level: int) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._compact(runs, level + 1)

    def _compact(self, runs: list[DataFrame], level: int) -> None:
        merged = runs[0]
        for run in runs[1:]:
            merged = merged.unionAll(run)
        merged = self._run(merged.groupBy("key").agg(F.sum("n_docs").alias("n_docs")), "merged")
        self.frequent.append(self._run(merged.filter(F.col("n_docs") >= self.min_docs).select("key"), "frequent"))
        rest = self._run(merged.filter(F.col("n_docs") < self.min_docs), "run")
        for run in [*runs, merged]:
            discard(run)
        self._place(rest, level)

    def add(self, batch: DataFrame) -> None:
        """``batch``: distinct keys with the number of documents that hold them."""
        for run in self.frequent:
            batch = batch.join(run, "key", "left_anti")
        self._place(self._run(batch, "run"), 0)

    def finish(self) -> DataFrame:
        """All keys found in at least ``min_docs`` documents."""
        runs = [run for level in self.levels for run in level]
        if runs:
            self.levels = []
            self._compact(runs, 0)
        out = self.frequent[0]
        for run in self.frequent[1:]:
            out = out.unionAll(run)
        return out


def line_key(line: Column) -> Column:
    """Digest of the line without outer white space and with A-Z lower-cased; null for blank lines."""
    bare = ascii_lower(F.btrim(line, F.lit(BLANKS)))
    return F.when(F.length(bare) > 0, F.unhex(F.md5(bare)))


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), F.xxhash64(whole).alias("raw"), F.split(whole, "\n", -1).alias("lines"))


def line_keys(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, raw, keys) of every row: the distinct keys of its non-blank lines."""
    keys = F.array_compact(F.array_distinct(F.transform("lines", line_key)))
    return _lines(docs, text, key).select("doc_id", "raw", keys.alias("keys"))


def frequent_lines(keys: DataFrame, min_docs: int = 10, batches: int = 4) -> DataFrame:
    """Keys held by at least ``min_docs`` rows of ``line_keys``, fed to the runs in ``batches`` parts."""
    held = keys.select(F.pmod(F.col("raw"), F.lit(batches)).alias("batch"), F.explode("keys").alias("key"))
    counts = stored(held.groupBy("batch", "key").agg(F.count(F.lit(1)).alias("n_docs")), "line-counts")
    runs = LineRuns(keys.sparkSession, min_docs)
    for batch in range(batches):
        runs.add(counts.filter(F.col("batch") == batch).select("key", "n_docs"))
    out = runs.finish()
    discard(counts)
    return out


def drop_frequent_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_docs: int = 10, batches: int = 4) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, kept_text.

    Every row counts as one document, repeated rows too. A null or empty text is one empty line;
    blank lines are never dropped; a text whose lines all go becomes empty. Columns other than the
    key and the text are ignored.
    """
    keys = stored(line_keys(docs, text, key), "line-keys")
    frequent = frequent_lines(keys, min_docs, batches)
    lines = _lines(docs, text, key)
    held = keys.select("doc_id", "raw", F.explode("keys").alias("key"))
    drops = (
        held.join(frequent, "key")
        .groupBy("doc_id", "raw")
        .agg(F.collect_set("key").alias("drop"))
        .select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"), "drop")
    )
    joined = lines.join(drops, lines["doc_id"].eqNullSafe(drops["_id"]) & (lines["raw"] == drops["_raw"]), "left")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.coalesce(F.array_contains("drop", line_key(line)), F.lit(False)))
    )
    return joined.select("doc_id", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept")).select(
        F.col("doc_id"),
        "n_lines",
        (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
        F.array_join("kept", "\n").alias("kept_text"),
    )


@query("op4_line_dedup", sql=r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = drop_frequent_lines(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
