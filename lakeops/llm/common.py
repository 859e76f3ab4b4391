"""What the training-data operators share: stored intermediates, text expressions, graph components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Event

import numpy as np
import pyarrow as pa
from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: ``[\x20\x09-\x0D]``, the white space of every text contract.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage is cut, sizes are known to the planner."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # What the write shuffles is of no use once the table is there.
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that no later step reads."""
    spark = df.sparkSession
    jvm = spark._jvm
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def collected(spark: SparkSession, seconds: float = 2.0) -> Iterator[None]:
    """While the block runs, the driver's JVM collects its garbage every few seconds, as Spark's cleaner does every half hour.

    For fits of many iterations whose vectors are large arrays: what an iteration drops is old by then, so the
    short collections leave it, and the heap would grow to its limit first.
    """
    ended = Event()

    def collect() -> None:
        while not ended.wait(seconds):
            spark._jvm.System.gc()

    thread = InheritableThread(target=collect, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()


def packed(values: np.ndarray) -> bytes:
    """An array of numbers, byte by byte of all of them in turn, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd"), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).reshape(-1)


def text_slices(texts: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Parts of a text column of about ``most`` characters; one text is never cut."""
    start, part, size = 0, [], 0
    for at, text in enumerate(texts):
        text = text.as_py() or ""
        part.append(text)
        size += len(text)
        if size >= most:
            yield start, part
            start, part, size = at + 1, [], 0
    if part:
        yield start, part


def ascii_lower(text: Column) -> Column:
    """A-Z only; ``lower`` does the same on texts of one byte a character, faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _stars(batches: Iterator[pa.RecordBatch], most: int = 300_000) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of a task, ``most`` at a time, as one star a component: every node to the smallest.

    The last node of a part goes into the next one too, so in input sorted by u no node is torn.
    """

    def contracted(held: list[pa.RecordBatch], carried: tuple | None) -> tuple[pa.RecordBatch, tuple]:
        above: dict = {}

        def top(x):
            while (y := above.get(x, x)) != x:
                above[x] = above.get(y, y)
                x = y
            return x

        def joined(u, v):
            u, v = top(u), top(v)
            if u != v:
                above[max(u, v)] = min(u, v)

        if carried:
            joined(*carried)
        for batch in held:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                joined(u, v)
        nodes, kind = list(above), held[0].schema
        star = [pa.array(nodes, kind.field("u").type), pa.array([top(x) for x in nodes], kind.field("v").type)]
        return pa.RecordBatch.from_arrays(star, names=["u", "v"]), (u, top(u))

    held, size, carried = [], 0, None
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= most:
            star, carried = contracted(held, carried)
            yield star
            held, size = [], 0
    if held:
        yield contracted(held, carried)[0]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (a, b): component is the smallest reachable node.

    Alternating large and small stars: each round hooks every node to the smallest neighbour, so
    the rounds grow with the logarithm of the longest chain. First the edges a task reads become
    stars of their own, in bounded memory, so a node has at most one smaller neighbour a part and
    the small stars can be made where the edges of a node meet. The rounds end when every node has
    one edge, to a node that has none; the neighbours of each node, gathered once a round, say so and
    are then the result, a stored table. Minima are combined before the shuffle, a hot node is joined,
    never gathered.
    """
    kind = links.schema["a"].dataType.simpleString()

    def starred(edges: DataFrame) -> DataFrame:
        return stored(edges.mapInArrow(_stars, f"u {kind}, v {kind}"), "edges")

    edges = starred(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v"))
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that a node with very many edges can be split in the join.
        smaller = F.when(F.col("v") < F.col("u"), F.col("v"))
        low = stored(both.groupBy("u").agg(F.min(smaller).alias("low"), F.max(smaller).alias("high"), F.max(F.col("v") > F.col("u")).alias("root")), "low")
        if low.filter("low <> high OR (low IS NOT NULL AND root)").isEmpty():
            discard(edges)
            return low.select(F.col("u").alias("node"), F.coalesce("low", "u").alias("component"))
        large = both.filter("v > u").join(low.select("u", F.coalesce("low", "u").alias("m")), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        after = starred(large.repartition("u").sortWithinPartitions("u"))
        discard(edges)
        discard(low)
        edges = after
