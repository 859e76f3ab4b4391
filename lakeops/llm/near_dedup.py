"""Near duplicates by fast similarity sketches, banding and exact verification.

A document is its set of distinct five-word shingles. Its sketch has a fixed number of bins: in each
round every shingle is hashed to one bin and a value, bins keep the smallest value of the first round
that reached them, and after as many rounds as bins, round t+i fills bin i outright. So every bin is
filled, in about two rounds over an ordinary text, and agreement of two sketches is concentrated
around the similarity of the sets. 32 bands of 4 bins meet for a pair at the threshold of 0.75 but for
5 in a million.

Equal sets are one node from the start. Nodes of a band bucket are verified against one leader, not
against each other; what that links is one component, and only nodes of a bucket in different
components are looked at again: under new leaders, and at last pair by pair. Before whole sets of
such a pair are compared, one bit of each of 2048 bins has to agree as often as at the threshold, less
five standard deviations (a pair at the threshold fails this once in three million). Nothing is capped or sampled. What remains quadratic is a comparison of 32 numbers
for nodes of one bucket in different components; it moves and emits nothing unless they agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.common import components, discard, query, stored, table, text_slices

WORDS = 5
BINS, ROWS = 128, 4
#: Bins of the sketches that open pairs are compared by, one bit of each.
LONG_BINS = 2048
EMPTY = np.uint64(2**64 - 1)
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; A-Z lower-cased, words split at ``[\\x20\\x09-\\x0D]``."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    total = np.full(len(words) - size + 1, np.uint64(size))
    for i in range(size):
        total = total + hashed[i : len(words) - size + 1 + i] * _MULTIPLIERS[i]
    return np.unique(_mixed(total))


def _ordered(hashed: np.ndarray, turn) -> np.ndarray:
    """The round in the high 16 bits, the hash below: a value of an earlier round is smaller."""
    return (hashed & np.uint64(2**48 - 1)) | (np.asarray(turn, np.uint64) << np.uint64(48))


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values a set; sets must not be empty."""
    out = np.full((len(sets), bins), EMPTY)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    def hashed(values: np.ndarray, turn) -> np.ndarray:
        return _mixed(values + (np.asarray(turn, np.uint64) + np.uint64(1)) * _MULTIPLIERS[0])

    active = np.arange(len(sets))
    for turn in range(bins):
        found = hashed(flat, [turn])
        bin_of = ((found >> np.uint64(48)) % np.uint64(bins)).astype(np.int64)
        np.minimum.at(out.reshape(-1), owner * bins + bin_of, _ordered(found, turn))
        still = (out[active] == EMPTY).any(axis=1)
        if not still.all():
            active = active[still]
            if not len(active):
                return out
            keep = np.isin(owner, active)
            flat, owner = flat[keep], owner[keep]
    # The rounds that fill one bin each, for all empty bins of a set at once.
    for i in active.tolist():
        empty = np.flatnonzero(out[i] == EMPTY)
        values = hashed(sets[i][:, None], bins + empty[None, :])
        out[i, empty] = _ordered(values, bins + empty[None, :]).min(axis=0)
    return out


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key a band of each sketch; the number of the band is part of it."""
    n, bins = sketch.shape
    parts = sketch.reshape(n, bins // rows, rows)
    key = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=np.uint64), (n, bins // rows)).copy()
    for i in range(rows):
        key = _mixed(key * _MULTIPLIERS[1] + parts[:, :, i])
    return key.astype(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, part in text_slices(batch.column("text"), 1_000_000):
            sets = [shingles(text) for text in part]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(sketches([sets[i] for i in full])) if full else np.zeros((0, BINS // ROWS), np.int64)
            row = {i: k for k, i in enumerate(full)}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(start, len(part)),
                    batch.column("raw").slice(start, len(part)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([keys[row[i]] if i in row else None for i in range(len(sets))], pa.list_(pa.int64())),
                ],
                names=["doc_id", "raw", "n_shingles", "node", "bands"],
            )


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, part in text_slices(batch.column("text"), 1_000_000):
            sets = [shingles(text).astype(np.int64) for text in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").slice(start, len(part)), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"]
            )


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The components (ca, cb) of the pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("both", both)
    return joined.filter(100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))).select(F.col("ca").alias("a"), F.col("cb").alias("b"))


def _merged(labelled: DataFrame, merges: DataFrame) -> DataFrame:
    """Rows with a component, under the component that it went into."""
    into = merges.select(F.col("node").alias("component"), F.col("component").alias("_into"))
    out = labelled.join(into, "component", "left").withColumn("component", F.coalesce("_into", "component"))
    return out.select(*labelled.columns)


def _open(labelled: DataFrame, turn: int) -> DataFrame:
    """Members of the buckets that hold more than one component, each with a leader of its bucket.

    The buckets are stored before the join, so that a hot one is split.
    """
    leader = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "n", "component")).alias("led")
    kinds = labelled.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), leader)
    kinds = stored(kinds.filter("c1 <> c2").select("key", "led"), "buckets")
    out = stored(labelled.join(kinds, "key"), "open")
    discard(kinds)
    return out


def _fits(percent: int):
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bit of each bin of a long sketch, 64 bits a number."""
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            sets = [np.array(s, np.int64).view(np.uint64) for s in part.column("shingles").to_pylist()]
            bits = (sketches(sets, LONG_BINS) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(list(packed), pa.list_(pa.int64()))], names=["node", "bits"])


def _most_different(percent: int) -> int:
    """Bits in which two long sketches at the threshold differ, with five standard deviations to spare."""
    share = (1 - percent / 100) / 2
    return int(LONG_BINS * share + 5 * (LONG_BINS * share * (1 - share)) ** 0.5)


def merges_of(nodes: DataFrame, sets_of, percent: int, rounds: int = 2) -> Iterator[DataFrame]:
    """What connects all similar nodes (node, n, bands), in steps: tables (node, component) that send
    components of the steps before to those they are part of. At first every node is a component.

    ``sets_of(nodes)`` gives (node, shingles) of the nodes asked for.
    """
    exploded = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = exploded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    members = stored(exploded.join(shared, "key").withColumn("component", F.col("node")), "members")
    if members.isEmpty():
        return
    sets = stored(sets_of(members.select("node").distinct()), "sets")
    for turn in range(rounds):
        # One leader a bucket; its pairs are decided, so it leaves the bucket.
        led = _open(members, turn)
        discard(members)
        pairs = led.filter("node <> led.node AND component <> led.component").select(
            F.col("node").alias("a"), F.col("led.node").alias("b"), F.col("n").alias("na"), F.col("led.n").alias("nb"),
            F.col("component").alias("ca"), F.col("led.component").alias("cb"),
        )
        pairs = pairs.filter(_fits(percent)).select("a", "b", "ca", "cb").distinct()
        merges = components(stored(_linked(pairs, sets, percent), "links"))
        yield merges
        left = led.filter("node <> led.node").select("node", "n", "key", "component")
        members = stored(_merged(left, merges), "members")
        discard(led)
        if members.isEmpty():
            return
    # What is open now goes pair by pair; a pair whose long sketches agree is one row, in however many bands it meets.
    open_ = _open(members, rounds)
    signed = stored(open_.select("node").distinct().join(sets, "node").mapInArrow(_signed, "node binary, bits array<long>"), "signed")
    open_ = open_.select("node", "n", "key", "component").join(signed, "node")
    names = ("node", "n", "component", "bits")
    one = open_.select("key", *[F.col(c).alias(f"{c}_a") for c in names])
    two = open_.select("key", *[F.col(c).alias(f"{c}_b") for c in names])
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(LONG_BINS // 64)])
    wanted = (
        (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
        & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    )
    rest = one.join(two, "key").filter(wanted & (differ <= _most_different(percent)))
    rest = rest.select(
        F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.col("component_a").alias("ca"), F.col("component_b").alias("cb")
    ).distinct()
    yield components(stored(_linked(rest, sets, percent), "links"))


def near_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = 75) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, raw (hash of the text).

    Rows are linked when their sets share ``percent`` of their union; component_id is the smallest key
    reachable. A text with fewer than five words is one shingle; without words, or null, it has none
    and is linked with nothing. Null keys count for nothing: a component of only such rows has a null
    id and keeps them. Other columns are ignored, whatever their names.
    """
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    given = given.withColumn("raw", F.xxhash64("text"))
    rows = stored(given.mapInArrow(_sketched, "doc_id long, raw long, n_shingles long, node binary, bands array<long>"), "sketches")
    # The row a set is read from again; of rows repeated in full any one will do. Equal sets have equal bands.
    first = rows.filter("node IS NOT NULL").groupBy("node", F.col("n_shingles").alias("n")).agg(
        F.min(F.struct("doc_id", "raw")).alias("row"), F.min("doc_id").alias("smallest"), F.first("bands").alias("bands")
    )
    first = stored(first, "nodes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        source = first.join(wanted, "node", "left_semi").select("node", F.col("row.doc_id").alias("_id"), F.col("row.raw").alias("_raw"))
        texts = given.join(source, given["doc_id"].eqNullSafe(source["_id"]) & (given["raw"] == source["_raw"])).select("node", "text")
        return texts.mapInArrow(_shingled, "node binary, shingles array<long>").dropDuplicates(["node"])

    whole = first.select("node", F.col("node").alias("component"), "smallest")
    for merges in merges_of(first.select("node", "n", "bands"), sets_of, percent):
        whole = _merged(whole, merges)
    whole = stored(whole, "components")
    least = whole.groupBy("component").agg(F.min("smallest").alias("smallest"))
    whole = whole.select("node", "component").join(least, "component").select("node", "smallest")
    named = rows.select("doc_id", "raw", "n_shingles", "node").join(whole, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return named.select("doc_id", "raw", "n_shingles", component.alias("component_id")).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"), "raw"
    )


def without_near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, one of each component, with all their columns; of rows that share key and text one."""
    name = lambda column: F.coalesce(column.cast("long").cast("string"), F.lit(""))
    stay = near_groups(docs, text, key).filter("kept").select(name(F.col("doc_id")).alias("_id"), F.col("raw").alias("_raw"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    marked = docs.select(row, F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("_raw"), name(docs[key]).alias("_id"))
    # Both sides are dealt by (_id, _raw) already, so dropping repeated rows shuffles nothing again.
    return marked.join(stay, ["_id", "_raw"], "left_semi").dropDuplicates(["_id", "_raw"]).select("row.*")


@query("op7_near_dedup", sql=r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d JOIN m ON m.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""")
def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents")).drop("raw")
