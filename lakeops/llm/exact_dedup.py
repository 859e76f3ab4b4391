"""Exact duplicates by deterministic block naming.

A normalised text is cut into fixed-size blocks. Equal blocks get one integer name by sorting;
adjacent names are then paired, distinct pairs are sorted and named again, until one name is left.
Two texts have the same (depth, name) exactly when they are equal: names come from comparing
whole blocks and whole pairs, so there are no collisions to hope away.

Blocks are first made distinct inside each Arrow batch, so a text that a third of all rows repeat
crosses the network once a batch. From then on only integers move. Names are ranks inside hash
buckets of the block, one bucket holding one 65,536th of the distinct blocks at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeops.llm.common import BLANKS, discard, query, stored, table

BUCKETS = 65_536


def _pieces(block_chars: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            chunk, known, local = partition << 32 | number, {}, []
            for text in batch.column("norm"):
                text = text.as_py()
                parts = [text[i : i + block_chars] for i in range(0, len(text), block_chars)] or [""]
                local.append([known.setdefault(part, len(known)) for part in parts])
            n, m = batch.num_rows, len(known)
            columns = {
                "chunk": pa.array([chunk] * (n + m), pa.int64()),
                "row": pa.array([*range(n), *[None] * m], pa.int64()),
                "local": pa.array([*local, *[None] * m], pa.list_(pa.int64())),
                "block_id": pa.array([*[None] * n, *range(m)], pa.int64()),
                "block": pa.array([*[None] * n, *known], pa.string()),
            }
            for name in ("doc_id", "n_points", "raw", "text_sha256"):
                column = batch.column(name)
                columns[name] = pa.concat_arrays([column, pa.nulls(m, column.type)])
            made = pa.RecordBatch.from_pydict(columns)
            for start in range(0, made.num_rows, 2_000):
                yield made.slice(start, 2_000)

    return cut


def _named(rows: DataFrame, *key: str) -> DataFrame:
    """Equal keys get one integer: bucket and rank in the sorted bucket."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*key))
    return rows.withColumn("bucket", bucket).withColumn("name", F.shiftleft("bucket", 40) + rank).drop("bucket")


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", block_chars: int = 4096) -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256, raw (hash of the original text).

    Texts are equal when identical without white space. Of equal texts the longest original stays,
    then the smallest key (null last), then the smallest hash of the original; of rows repeated in
    full exactly one stays. A null text is an empty one; empty texts are equal to each other. Other
    columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        normalised(F.col(text)).alias("norm"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_points"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("raw"),
    ).withColumn("text_sha256", F.sha2("norm", 256))
    pieces = stored(
        base.mapInArrow(
            _pieces(block_chars),
            "chunk long, row long, local array<long>, block_id long, block string, "
            "doc_id long, n_points long, raw long, text_sha256 string",
        ),
        "pieces",
    )
    rows = pieces.filter("row IS NOT NULL").select("chunk", "row", "doc_id", "n_points", "raw", "text_sha256")
    blocks = pieces.filter("row IS NULL").select("chunk", "block_id", "block")
    names = stored(_named(blocks, "block").select("chunk", "block_id", "name"), "names")
    sequence = (
        pieces.filter("row IS NOT NULL")
        .select("chunk", "row", F.size("local").alias("left"), F.posexplode("local").alias("pos", "block_id"))
        .join(names, ["chunk", "block_id"])
        .select("chunk", "row", "left", "pos", "name")
    )
    level, current = 0, stored(sequence, "sequence")
    finished = [(current.filter("left = 1"), 0)]
    longest = current.agg(F.max("left")).first()[0] or 1
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        side = F.col("pos") % 2
        pairs = (
            current.filter("left > 1")
            .groupBy("chunk", "row", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(
                F.max(F.when(side == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("b"),
                F.expr("(max(left) + 1) div 2").cast("int").alias("left"),
            )
        )
        pairs = stored(pairs, "pairs")
        naming = _named(pairs.select("a", "b").distinct(), "a", "b")
        following = stored(pairs.join(naming, ["a", "b"]).select("chunk", "row", "left", "pos", "name"), "sequence")
        discard(pairs)
        finished.append((following.filter("left = 1"), level))
        current = following
    done = None
    for part, depth in finished:
        part = part.select("chunk", "row", F.lit(depth).alias("depth"), "name")
        done = part if done is None else done.unionAll(part)
    identified = stored(rows.join(done, ["chunk", "row"]), "identified")
    order = F.struct(
        (-F.col("n_points")).alias("o1"), F.col("doc_id").isNull().alias("o2"), F.col("doc_id").alias("doc_id"),
        F.col("raw").alias("o3"), F.col("chunk").alias("chunk"), F.col("row").alias("row"),
    )
    # Stored, so that the join is between two exchanges and a hot group can be split.
    groups = stored(identified.groupBy("depth", "name").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")), "groups")
    kept = (F.col("chunk") == F.col("first.chunk")) & (F.col("row") == F.col("first.row"))
    return identified.join(groups, ["depth", "name"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "raw"
    )


def without_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The input rows that ``exact_groups`` keeps, with all their columns."""
    kept = exact_groups(docs, text, key).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("raw").alias("_kept_raw"))
    raw = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    marked = docs.withColumns({"_raw": raw, "_id": docs[key].cast("long")})
    same = marked["_id"].eqNullSafe(kept["_kept_id"]) & (marked["_raw"] == kept["_kept_raw"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["_id", "_raw"]).drop("_id", "_raw")


@query("op5_exact_dedup", sql=r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
g AS (
  SELECT doc_id, n, count(*) OVER (PARTITION BY n) AS group_size,
         first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM g""")
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents")).drop("raw")
