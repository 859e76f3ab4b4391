"""Language-model scores of documents by a probabilistic suffix tree over words.

A node of the tree is a context: the last 1 to ``depth`` words. It becomes a state if its next words
differ enough from those of the context one word shorter: the log-likelihood ratio of its training
occurrences has to exceed half the log of their number for each next word it tells apart. The
distribution of a state mixes its own counts with that of its longest suffix that is a state, by the
number of different next words; the root's is add-a-half over words. A word is scored by the longest
suffix of what precedes it that is a state.

Documents are cut into blocks of word codes, stored once. In each round a block asks for what it needs,
its distinct n-grams of one length: asks are shuffled by ranges of n-gram hashes, counted over all blocks
and answered to the blocks. So a frequent n-gram moves once a block, not once an occurrence. An n-gram is
asked for only if its context and its suffix are frequent enough to matter. Contexts are tested in the
same way, those of one length a round, one round after their next words are counted. Words and n-grams
are 64-bit hashes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakeops.llm.common import discard, packed, query, stored, table, unpacked

#: What stands before the first word and after the last one; no word has white space.
OPEN, END = b"\n", b" "
BLOCK = 500_000
#: Positions a range of n-gram hashes is meant for.
RANGE = 2**20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words, A-Z lower-cased, and the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes, as steps from one to the next."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def _blocked(depth: int, block: int, kind: pa.DataType) -> Callable:
    """Blocks of documents (key, text, train). A document longer than a block goes on in the next one,
    with the ``depth`` words before it as context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        made = row = 0
        ids: dict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        codes: list[np.ndarray] = []
        parts: list[tuple[int, int, int, int]] = []  # row, whether learned from, words that are context, words
        begun: list[tuple] = []
        held = 0

        def flushed() -> pa.RecordBatch:
            nonlocal made, held
            words = np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([base + made], pa.int64()), pa.array([held], pa.int64()),
                    *(pa.array([packed(x)], pa.binary()) for x in (np.array(parts, np.int64).reshape(-1), words, np.concatenate(codes).astype(np.uint32))),
                    pa.array([[r for r, _ in begun]], pa.list_(pa.int64())), pa.array([[k for _, k in begun]], pa.list_(kind)),
                ],
                names=["block", "size", "parts", "words", "codes", "rows", "keys"],
            )
            made, held = made + 1, 0
            for x in (ids, codes, parts, begun):
                x.clear()
            return out

        for batch in batches:
            for key, text, train in zip(batch.column("key"), batch.column("text"), batch.column("train"), strict=True):
                words = words_of(text.as_py())
                begun.append((base + row, key.as_py()))
                for at in range(0, len(words), block):
                    context = words[at - depth : at] if at else [OPEN]
                    part = context + words[at : at + block]
                    codes.append(np.fromiter(map(ids.__getitem__, part), np.int64, len(part)))
                    parts.append((base + row, train.as_py(), len(context), len(part)))
                    held += len(part)
                    if held >= block:
                        yield flushed()
                row += 1
        if held:
            yield flushed()

    return run


class Block:
    """Positions of a block: their words, and what answers say of the n-grams that end there."""

    def __init__(self, parts: np.ndarray, words: np.ndarray, codes: np.ndarray) -> None:
        row, train, context, length = parts.reshape(-1, 4).T
        self.row, self.part = row, np.repeat(np.arange(len(row)), length)
        start = np.cumsum(length) - length
        self.place = np.arange(len(codes)) - start[self.part]
        self.real = self.place >= context[self.part]
        self.opens = ~self.real & (context[self.part] == 1) & (words[codes] == np.uint64(xxhash.xxh3_64_intdigest(OPEN)))
        self.learned = (train[self.part] == 1) & (self.real | self.opens)
        self.grams = [np.zeros(0, np.uint64), words[codes]]
        self.counts: list[np.ndarray] = [np.zeros(0, np.int64)]

    def asks(self, level: int, least_context: int, least_next: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which positions ask for their n-gram of ``level`` words, the distinct ones in order, and which each asks for."""
        if level > 1:
            before = self.grams[level - 1]
            gram = before.copy()
            mixed = (before[:-1] * _ODD + self.grams[1][1:]) ^ (before[:-1] >> np.uint64(29))
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            gram[1:] = mixed ^ (mixed >> np.uint64(31))
            self.grams.append(gram)
            wanted = self.place >= level - 1
            wanted[1:] &= (self.counts[level - 1][:-1] >= least_context) & (self.counts[level - 1][1:] >= least_next)
        else:
            wanted = np.ones(len(self.place), bool)
        return wanted, *np.unique(self.grams[level][wanted], return_inverse=True)

    def answered(self, wanted: np.ndarray, which: np.ndarray, answer: np.ndarray) -> None:
        found = np.zeros(len(self.place), np.int64)
        found[wanted] = answer[which]
        self.counts.append(found)

    def contexts(self, depth: int, least_context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions whose context of ``depth`` words is frequent, the contexts in order, and which each has."""
        at = np.flatnonzero(self.real & (self.place >= depth))
        at = at[self.counts[depth][at - 1] >= least_context]
        return at, *np.unique(self.grams[depth][at - 1], return_inverse=True)


def _split(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The ranges of hashes that sorted keys fall into."""
    at = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield int(at[a]), slice(a, b)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "level", "range", "keys", "payload"])


ROWS = "block long, level int, range long, keys binary, payload binary"


def _grouped(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows in a row with the same values of some columns."""
    key, held = (), []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            here = tuple(row[name] for name in names)
            if held and here != key:
                yield key, held
                held = []
            key = here
            held.append(row)
    if held:
        yield key, held


def _rebuilt(rows: list[dict], levels: int, least_context: int, least_next: int) -> Block:
    """A block with the answers up to n-grams of ``levels`` words, from rows sorted by (level, range)."""
    parts: dict[int, list[bytes]] = defaultdict(list)
    for row in rows:
        parts[row["level"]].append(row["payload"])
    block = Block(unpacked(parts[-2][0], np.int64), unpacked(parts[-1][0], np.uint64), unpacked(parts[0][0], np.uint32))
    for level in range(1, levels + 1):
        wanted, _, which = block.asks(level, least_context, least_next)
        block.answered(wanted, which, np.concatenate([np.zeros(0, np.int64), *(unpacked(p, np.int64) for p in parts[level])]))
    return block


#: The level of answers about contexts.
TEST = 1_000


def _tests(number: int, block: Block, d: int, words: int, bits: int, least_context: int, least_next: int) -> list[tuple]:
    """What a block's training occurrences say of their contexts of ``d`` words: n, the occurrences of next words
    told apart, how many different ones these are, and their log-likelihood ratio to the shorter context."""
    at, keys, which = block.contexts(d, least_context)
    n, c = block.counts[d][at - 1], block.counts[d + 1][at]
    own = (c >= least_next) & block.learned[at]
    shorter = block.counts[d - 1][at - 1][own] if d > 1 else np.full(int(own.sum()), words)
    told = np.log(c[own] / n[own]) - np.log(block.counts[d][at][own] / shorter)
    values = np.zeros((4, len(keys)))
    values[0][which] = n
    values[1] = np.bincount(which[own], minlength=len(keys))
    values[2] = np.bincount(which[own], 1 / c[own], minlength=len(keys))
    values[3] = np.bincount(which[own], told, minlength=len(keys))
    out = []
    for at_, part in _split(keys, bits):
        # Two numbers that are whole in a block, two of which single precision is enough.
        short = np.concatenate([values[:2, part].astype(np.uint32), values[2:, part].astype(np.float32).view(np.uint32)])
        out.append((number, TEST + d, at_, packed_keys(keys[part]), packed(short.reshape(-1))))
    return out


def _asking(level: int, words: int, depth: int, bits: int, least_context: int, least_next: int) -> Callable:
    """Asks for n-grams of ``level`` words (up to one more than ``depth``), and tests of the contexts two words
    shorter, whose next words the last round has counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number,), rows in _grouped(batches, "block"):
            block = _rebuilt(rows, level - 1, least_context, least_next)
            if level > 2:
                yield _batch(_tests(number, block, level - 2, words, bits, least_context, least_next))
            if level <= depth + 1:
                wanted, keys, which = block.asks(level, least_context, least_next)
                learned = np.bincount(which[block.learned[wanted]], minlength=len(keys))
                yield _batch([(number, level, at, packed_keys(keys[part]), packed(learned[part])) for at, part in _split(keys, bits)])

    return run


def _answering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Asks and tests of one range of hashes, answered over all blocks."""
    for (level, at), rows in _grouped(batches, "level", "range"):
        yield _batch((_judged if level > TEST else _counted)(level, at, rows))


def _counted(level: int, at: int, rows: list[dict]) -> list[tuple]:
    """The counts over all blocks. One row a range (block -1) has the number of n-grams that were learned, and of
    their occurrences."""
    keys = [unpacked_keys(row["keys"]) for row in rows]
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, np.concatenate([unpacked(row["payload"], np.int64) for row in rows])).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    out = [(row["block"], level, at, None, packed(total[which[e - len(k) : e]])) for row, k, e in zip(rows, keys, ends, strict=True)]
    return [*out, (-1, level, at, None, np.array([np.count_nonzero(total), total.sum()], np.int64).tobytes())]


def _judged(level: int, at: int, rows: list[dict]) -> list[tuple]:
    """Whether contexts are states: of those that are, the occurrences of next words told apart and how many these are."""
    keys = [unpacked_keys(row["keys"]) for row in rows]
    _, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    short = np.concatenate([unpacked(row["payload"], np.uint32).reshape(4, -1) for row in rows], axis=1)
    n = short[0][first].astype(np.float64)
    total = np.bincount(which, short[1])
    different, ratio = (np.bincount(which, x.view(np.float32)) for x in np.ascontiguousarray(short[2:]))
    different = np.round(different)  # each next word adds 1, in parts
    state = ratio > 0.5 * different * np.log(np.maximum(n, 2))
    said = np.stack([np.where(state, total, -1.0), np.where(state, different, 0.0)], axis=1)
    ends = np.cumsum([len(k) for k in keys])
    return [(row["block"], level, at, None, packed(said[which[e - len(k) : e]].reshape(-1))) for row, k, e in zip(rows, keys, ends, strict=True)]


def root(c: np.ndarray, words: int, distinct: int) -> np.ndarray:
    return (c + 0.5) / (words + 0.5 * (distinct + 1))


def _scoring(depth: int, words: int, distinct: int, least_context: int, least_next: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, "block"):
            said = defaultdict(list)
            for row in rows:
                if row["level"] > TEST:
                    said[row["level"] - TEST].append(unpacked(row["payload"], np.float64))
            block = _rebuilt(rows, depth + 1, least_context, least_next)
            base = root(block.counts[1], words, distinct)
            p = base.copy()
            for d in range(1, depth + 1):
                at, keys, which = block.contexts(d, least_context)
                if not len(keys):
                    continue
                total, different = np.concatenate(said[d]).reshape(-1, 2)[which].T
                state = total >= 0
                at, total, different = at[state], total[state], different[state]
                n, c = block.counts[d][at - 1], block.counts[d + 1][at]
                p[at] = (np.where(c >= least_next, c, 0) + (n - total + different) * p[at]) / (n + different)
            own, number = block.real, len(block.row)
            sums = [np.bincount(block.part[own], x, minlength=number) for x in (np.ones(int(own.sum())), block.counts[1][own] > 0, np.log10(base[own]), np.log10(p[own]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.row), *(pa.array(x.astype(np.int64)) for x in sums[:2]), *(pa.array(x) for x in sums[2:])],
                names=["row", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def suffix_tree_scores(
    docs: DataFrame, learn: Column, text: str = "text", key: str = "doc_id", depth: int = 2, least_context: int = 20, least_next: int = 2, block: int = BLOCK
) -> DataFrame:
    """One row per input row: the key, n_tokens, n_known, train_tokens, base_score and score.

    The model learns from the rows where ``learn`` holds. Scores are log10 probabilities of the words of
    a text and its end: base_score by the root alone, score by the tree. A context needs
    ``least_context`` occurrences, and next words with fewer than ``least_next`` after it share what it
    leaves to shorter contexts. A null text is empty (only its end), repeated rows count each time, a
    text of any length is read whole, other columns are ignored. Without rows to learn from every word
    has the probability 1; an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).cast("long").alias("train"))
    arrow = to_arrow_type(docs.schema[key].dataType)
    blocks = stored(
        given.mapInArrow(
            _blocked(depth, block, arrow), f"block long, size long, parts binary, words binary, codes binary, rows array<long>, keys array<{kind}>"
        ),
        "blocks",
    )
    none = F.lit(None).cast("binary")
    listed = F.array(*[F.struct(F.lit(k).alias("level"), F.col(c).alias("payload")) for k, c in ((-2, "parts"), (-1, "words"), (0, "codes"))])
    known = blocks.select("block", F.inline(listed)).select("block", "level", F.lit(0).cast("long").alias("range"), none.alias("keys"), "payload")
    positions = blocks.agg(F.sum("size")).first()[0] or 0
    bits = max(3, (positions // RANGE).bit_length())
    least = (least_context, least_next)

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition("block").sortWithinPartitions("block", "level", "range")

    def answered(level: int, words: int) -> DataFrame:
        asks = (together(known) if level > 1 else known).mapInArrow(_asking(level, words, depth, bits, *least), ROWS)
        dealt = asks.repartition("level", "range").sortWithinPartitions("level", "range", "block")
        return stored(dealt.mapInArrow(_answering, ROWS), f"round-{level}")

    answers, tested, words = [], [], 0
    # Contexts are tested in the round after the one that counts their next words, so that no shuffle holds the tests of all lengths.
    for level in range(1, depth + 3):
        answer = answered(level, words)
        if level == 1:
            sums = answer.filter("block = -1").select("payload").mapInArrow(_summed, "distinct long, total long").agg(F.sum("distinct"), F.sum("total")).first()
            opened = given.agg(F.sum("train")).first()[0] or 0
            words, distinct = (sums[1] or 0) - opened, (sums[0] or 0) - (opened > 0)
        answers.append(answer)
        if level > 2:
            tested.append(answer.filter(F.col("level") > TEST))
        if level <= depth + 1:
            known = known.unionAll(answer.filter((F.col("block") >= 0) & (F.col("level") < TEST)))
    scores = together(reduce(DataFrame.unionAll, tested, known)).mapInArrow(
        _scoring(depth, words, distinct, *least), "row long, n_tokens long, n_known long, base_score double, score double"
    )
    sums = scores.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    names = blocks.select(F.inline(F.arrays_zip("rows", "keys")).alias("row", key))
    out = names.join(sums, "row").select(key, "n_tokens", "n_known", F.lit(words).cast("long").alias("train_tokens"), "base_score", "score")
    out = stored(out, "scores")
    for done in (blocks, *answers):
        discard(done)
    return out


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [np.frombuffer(x.as_py(), np.int64) for x in batch.column("payload")]
        yield pa.RecordBatch.from_arrays([pa.array([int(p[k]) for p in pairs], pa.int64()) for k in (0, 1)], names=["distinct", "total"])


def held_out(key: str = "doc_id") -> Column:
    """Rows not learned from: crc32 of the key as text leaves 1 when divided by 5. A null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 1


@query("op12_suffix_tree")
def op12_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    scores = suffix_tree_scores(table(spark, folder, "documents"), ~held_out())
    return scores.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
