"""Phrases of words that keep together, mined with stripes.

A stripe belongs to a prefix of 0 to 3 words and counts the words that follow it: an associative
counter, combined in the task that reads the texts and merged element by element after the shuffle. An
entry ``.`` counts where a prefix is not extended. One merged stripe gives the extensions of its
prefix (phrases one word longer), the prefix's own total, and the largest extension, which is what
can subsume the prefix; words in total are the sum of the stripes of the empty prefix.

Texts are read once, into blocks of word codes. Stripes are made from these length by length: a phrase is
as rare as its rarest part, so only occurrences whose first and last words (all but one) are both
frequent are counted. Tasks learn of frequent phrases from a Bloom filter of fixed size: a false
positive, or a filter that fills up on a very large corpus, costs work and changes no count. A stripe of a prefix with many occurrences is cut into slices by its next word.
A block's stripes are shuffled in bundles, one for each range of hashes of prefix and slice, as compressed columns.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeops.llm.common import LOWER, UPPER, discard, packed, query, stored, table, unpacked

BREAKS = b".,;:!?\n\x0b\x0c\r"
END = b"."  # between pieces; no word holds it
_TABLE = bytes.maketrans(UPPER.encode() + BREAKS, LOWER.encode() + END * len(BREAKS))
#: Bits of the filter of frequent phrases, as a power of two, and bits looked at for a phrase.
BITS, PROBES = 25, 4
#: Slices of the stripes of the empty prefix.
ROOT_SLICES = 512
#: A prefix is hot from that many occurrences, or its share of all words: at most MOST_HOT prefixes a length are.
LEAST_HOT, MOST_HOT = 200_000, 20_000
#: Ranges of hashes that stripes are shuffled by: as a power of two at least, and blocks of all languages that a range is meant for.
LEAST_BITS, BLOCKS_A_RANGE = 6, 4
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Known:
    """What tasks know of the phrases one word shorter: the filter, and the slices of hot prefixes by language."""

    bits: np.ndarray | None = None
    slices: dict[tuple[str, str], int] = field(default_factory=dict)


def tokens_of(texts: list[str]) -> list[bytes]:
    """Words of texts, with ``.`` where pieces end."""
    return b" . ".join(t.encode("utf-8", "surrogatepass").translate(_TABLE).replace(END, b" . ") for t in texts).split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))


def _chained(hashed: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mixed(hashed * _ODD + word)


def _probes(hashed: np.ndarray) -> Iterator[np.ndarray]:
    step = (hashed >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield (hashed + np.uint64(k) * step) & np.uint64(2**BITS - 1)


def _held(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashed), bool)
    for at in _probes(hashed):
        found &= ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
    return found


def coded(tokens: list[bytes]) -> tuple[list[str], np.ndarray]:
    """The distinct words, ``.`` first, and the place of each token's word among them."""
    ids: dict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    ids[END]
    codes = np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))
    return [word.decode("utf-8", "surrogatepass") for word in ids], codes


def _coded(most: int = 8_000_000, most_held: int = 12_000_000):
    """Texts of one language as blocks of word codes, about ``most`` characters each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = defaultdict(list)
        size: Counter = Counter()

        def block(lang: str) -> pa.RecordBatch:
            words, codes = coded(tokens_of(held.pop(lang)))
            del size[lang]
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([words], pa.list_(pa.string())), pa.array([packed(codes.astype(np.uint32)) if len(codes) else None], pa.binary())],
                names=["lang", "words", "codes"],
            )

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                lang, text = lang.as_py(), text.as_py()
                held[lang].append(text)
                size[lang] += len(text)
                if size[lang] >= most:
                    yield block(lang)
                elif size.total() >= most_held:
                    yield block(max(size, key=size.get))
        for lang in list(held):
            yield block(lang)

    return run


def stripes_of(lang: str, words: list[str], codes: np.ndarray, width: int, known: Known) -> pa.RecordBatch | None:
    """The stripes (lang, prefix, slice, next, n) of prefixes of ``width`` words, cut into slices."""
    made = _hashed_stripes(lang, words, codes, width, known)
    return made and made[0]


def _hashed_stripes(lang: str, words: list[str], codes: np.ndarray, width: int, known: Known) -> tuple[pa.RecordBatch, np.ndarray] | None:
    """``stripes_of``, and a hash of each stripe's prefix and slice."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    # Where a run of ``width`` words of one piece begins that may be frequent.
    inside = codes != 0
    if width == 0:
        starts, followed, chained = np.append(inside, False), inside, np.zeros(len(codes) + 1, np.uint64)
    else:
        word_at = hashes[codes]
        starts = np.ones(max(0, len(codes) - width + 1), bool)
        chained = np.full(len(starts), _seed(lang))
        for k in range(width):
            starts &= inside[k : k + len(starts)]
            chained = _chained(chained, word_at[k : k + len(starts)])
        starts[starts] = _held(known.bits, chained[starts])
        followed = starts[:-1] & starts[1:]
    at = np.flatnonzero(starts)
    if not len(at):
        return None
    prefix = codes[at] if width else np.zeros(len(at), np.int64)
    for k in range(1, width):
        prefix = np.unique((prefix << 32) | codes[at + k], return_inverse=True)[1]
    _, where, prefix = np.unique(prefix, return_index=True, return_inverse=True)
    extended = np.append(followed, False)[at]
    pair, n = np.unique((prefix[extended] << 32) | codes[at[extended] + width], return_counts=True)
    rest = np.bincount(prefix, minlength=len(where)) - np.bincount(prefix[extended], minlength=len(where))
    ended = np.flatnonzero(rest)
    pair, n = np.concatenate([ended << 32, pair]), np.concatenate([rest[ended], n])
    owner, following = pair >> 32, pair & 0xFFFFFFFF
    vocabulary = pa.array(words, pa.string())
    spelt = [vocabulary.take(pa.array(codes[at[where] + k])) for k in range(width)]
    prefixes = pc.binary_join_element_wise(*spelt, " ") if spelt else pa.array([""])
    cuts = np.full(len(where), 1 if width else ROOT_SLICES, np.uint64)
    hot = {p: n for (of, p), n in known.slices.items() if of == lang} if width else {}
    if hot:
        found = pc.index_in(prefixes, value_set=pa.array(list(hot))).fill_null(-1).to_numpy(zero_copy_only=False)
        cuts = np.where(found >= 0, np.array(list(hot.values()), np.uint64)[found], cuts)
    piece = np.where(following == 0, np.uint64(0), hashes[following] % cuts[owner]).astype(np.int64)
    order = np.lexsort((piece, owner))
    owner, piece, following, n = owner[order], piece[order], following[order], n[order]
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])))
    offsets = np.append(first, len(owner)).astype(np.int32)
    hashed = _chained(chained[at[where]][owner[first]], piece[first].astype(np.uint64))
    out = pa.RecordBatch.from_arrays(
        [
            pa.array([lang]).take(pa.array(np.zeros(len(first), np.int64))),
            prefixes.take(pa.array(owner[first])),
            pa.array(piece[first].astype(np.int32)),
            # No word has a space: one text is shorter than a list.
            pc.binary_join(pa.ListArray.from_arrays(offsets, vocabulary.take(pa.array(following))), " "),
            pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32))),
        ],
        names=["lang", "prefix", "slice", "next", "n"],
    )
    return out, hashed


def _joined(texts: pa.Array) -> bytes:
    """Texts without line ends, compressed as one: each after a line end, so that there are bytes for an empty one too."""
    return packed(np.frombuffer("\n".join(["", *texts.to_pylist()]).encode(), np.uint8))


def _parted(data: bytes) -> pa.Array:
    return pc.split_pattern(pa.array([unpacked(data, np.uint8)[1:].tobytes().decode()]), "\n").flatten()


def bundles_of(stripes: pa.RecordBatch, hashed: np.ndarray, bits: int) -> pa.RecordBatch:
    """Stripes of a block, those of one range of hashes as one row of compressed columns."""
    at = (hashed >> np.uint64(64 - bits)).astype(np.int32)
    order = np.argsort(at, kind="stable")
    stripes, at = stripes.take(pa.array(order)), at[order]
    cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1])).tolist()
    parts = [stripes.slice(a, b - a) for a, b in zip(cuts, [*cuts[1:], len(at)], strict=True)]
    columns = [
        [_joined(part.column("prefix")) for part in parts],
        [packed(part.column("slice").to_numpy()) for part in parts],
        [_joined(part.column("next")) for part in parts],
        [packed(part.column("n").flatten().to_numpy()) for part in parts],
    ]
    return pa.RecordBatch.from_arrays(
        [stripes.column("lang").slice(0, len(parts)), pa.array(at[cuts]), *(pa.array(c, pa.binary()) for c in columns)],
        names=["lang", "range", "prefix", "slice", "next", "n"],
    )


def _merged(least: int):
    """Bundles sorted by (lang, range), their stripes merged element by element: total, and the entries of at least ``least``."""

    def merged(lang: str, bundles: list[tuple[bytes, ...]]) -> pa.RecordBatch:
        prefix, piece, following, n = zip(*bundles, strict=True)
        prefixes = pa.chunked_array([_parted(x) for x in prefix]).combine_chunks().dictionary_encode()
        key = (prefixes.indices.to_numpy().astype(np.int64) << 32) | np.concatenate([unpacked(x, np.int32) for x in piece])
        keys, number = np.unique(key, return_inverse=True)
        listed = pc.split_pattern(pa.chunked_array([_parted(x) for x in following]).combine_chunks(), " ")
        entry = {
            "stripe": np.repeat(number, listed.value_lengths().to_numpy()), "next": listed.flatten(),
            "n": np.concatenate([unpacked(x, np.int32) for x in n]).astype(np.int64),
        }
        entries = pa.table(entry).group_by(["stripe", "next"]).aggregate([("n", "sum")])
        stripe, n = entries["stripe"].to_numpy(), entries["n_sum"].to_numpy()
        total = np.bincount(stripe, n, minlength=len(keys)).astype(np.int64)
        kept = entries.filter(pa.array(n >= least)).filter(pc.field("next") != ".").sort_by("stripe")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(kept["stripe"].to_numpy(), minlength=len(keys)))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, kept[c].combine_chunks()) for c in ("next", "n_sum")]
        spelt = prefixes.dictionary.take(pa.array(keys >> 32))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), spelt, pa.array(total), *lists], names=["lang", "prefix", "total", "next", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            for lang, at, *bundle in zip(*(batch.column(c).to_pylist() for c in ("lang", "range", "prefix", "slice", "next", "n")), strict=True):
                if held and (lang, at) != here:
                    yield merged(here[0], held)
                    held = []
                here = (lang, at)
                held.append(tuple(bundle))
        if held:
            yield merged(here[0], held)

    return run


def stripes(blocks: DataFrame, width: int, known: Known, least: int, bits: int) -> DataFrame:
    """Merged stripes (lang, prefix, total, next, n) of blocks (lang, words, codes), a row a slice; stored. They are
    shuffled in bundles, by ``2 ** bits`` ranges of hashes."""
    shared = blocks.sparkSession.sparkContext.broadcast(known)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, codes in zip(*(batch.column(c) for c in ("lang", "words", "codes")), strict=True):
                made_ = _hashed_stripes(lang.as_py(), words.as_py(), unpacked(codes.as_py(), np.uint32).astype(np.int64), width, shared.value)
                if made_ is not None:
                    yield bundles_of(*made_, bits)

    parts = blocks.mapInArrow(made, "lang string, range int, prefix binary, slice binary, next binary, n binary")
    keys = ("lang", "range")
    dealt = parts.repartition(*keys).sortWithinPartitions(*keys)
    out = stored(dealt.mapInArrow(_merged(least), "lang string, prefix string, total long, next array<string>, n array<long>"), f"stripes-{width}")
    shared.unpersist()
    return out


def _filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the filter that phrases set, with the bits."""
    for batch in batches:
        hashed = np.empty(batch.num_rows, np.uint64)
        for i, (lang, phrase) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)):
            value = np.full(1, _seed(lang))
            for word in phrase.encode("utf-8", "surrogatepass").split(b" "):
                value = _chained(value, np.uint64(xxhash.xxh3_64_intdigest(word)))
            hashed[i] = value[0]
        at = np.concatenate(list(_probes(hashed)))
        slot, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(bit.view(np.int64))], names=["slot", "bit"])


def known_of(phrases: DataFrame, words: int) -> Known:
    """The filter and the hot prefixes of phrases (lang, phrase, f); ``words``: all words there are."""
    set_ = phrases.select("lang", "phrase").mapInArrow(_filtered, "slot long, bit long").groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    listed = set_.toArrow()  # at most 2 ** (BITS - 6) rows
    bits = np.zeros(2 ** (BITS - 6), np.int64)
    bits[listed.column("slot").to_numpy()] = listed.column("bits").to_numpy()
    part = max(LEAST_HOT, words // MOST_HOT)
    hot = phrases.filter(F.col("f") >= part).collect()  # occurrences add up to ``words`` at most, so MOST_HOT of them
    return Known(bits.view(np.uint64), {(r.lang, r.phrase): 1 + r.f // part for r in hot})


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4, least: int = 30, share: int = 80, most: int | None = 2_000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the phrases of 2 to ``longest`` words that occur ``least`` times.

    a, l and r count the phrase and the two parts of its lowest-scoring cut, n all words of the
    language; score is floor(2000000 a / (l + r)), exact at any size. A phrase inside a longer one that
    occurs at least ``share`` percent as often is left out. ``most`` phrases a language are ranked by
    score, a, phrase (None: all). A null lang is ``und``, a null text empty; a text is read whole,
    repeated rows count each time, other columns are ignored; an empty table gives no rows.
    """
    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blocks = given.mapInArrow(_coded(), "lang string, words array<string>, codes binary").filter("codes IS NOT NULL")
    blocks = stored(blocks, "phrase-blocks")
    known, totals, longer, merged = Known(), [], [], [blocks]
    bits = max(LEAST_BITS, (blocks.count() // BLOCKS_A_RANGE).bit_length())
    for width in range(longest):
        level = stripes(blocks, width, known, least, bits)
        merged.append(level)
        entry = level.select("lang", "prefix", F.inline(F.arrays_zip("next", "n")).alias("next", "f"))
        phrase = F.concat_ws(" ", "prefix", "next") if width else F.col("next")
        found = entry.select("lang", phrase.alias("phrase"), "f", "prefix")
        if width == 0:
            sums = level.groupBy("lang").agg(F.sum("total").alias("n"))
            words = sums.agg(F.sum("n")).first()[0] or 0
        else:
            totals.append(level.groupBy("lang", F.col("prefix").alias("part")).agg(F.sum("total").alias("f")))
            longer.append(found)
        if width < longest - 1:
            known = known_of(found.select("lang", "phrase", "f"), words)
    part = totals[0]
    for more in totals[1:]:
        part = part.unionAll(more)
    candidate = longer[0]
    for more in longer[1:]:
        candidate = candidate.unionAll(more)
    candidate = candidate.withColumn("words", F.split("phrase", " "))
    # A phrase is as rare as its rarest part, so of longer phrases those with one word more are enough.
    inner = F.explode(F.array("prefix", F.array_join(F.slice("words", F.lit(2), F.size("words")), " "))).alias("phrase")
    larger = candidate.filter(F.size("words") > 2).select("lang", inner, "f").groupBy("lang", "phrase").agg(F.max("f").alias("larger"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = candidate.join(larger, ["lang", "phrase"], "left").filter(F.col("larger").isNull() | (wide("larger") * 100 < wide("f") * share))
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "words", cut)
    joined = lambda *at: F.array_join(F.slice("words", *at), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.size("words")).alias("right"))
    cuts = cuts.join(part.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("(CAST(a AS decimal(20,0)) * CAST(2000000 AS decimal(7,0))) DIV (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    ranked = best.select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(by))
    if most is not None:
        ranked = ranked.filter(F.col("rank") <= most)
    out = ranked.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    out = stored(out, "phrases")
    for level in merged:
        discard(level)
    return out


@query("op13_phrases", sql=r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) r(k) WHERE len(w) >= k))
  GROUP BY 1, 2, 3 HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY 1),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS larger
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM c, range(2, 4) r(m) WHERE m < k) GROUP BY 1, 2),
cut AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:k], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (
  SELECT cut.lang, cut.phrase, cut.a, x.f AS l, y.f AS r, (2000000::HUGEINT * cut.a) // (x.f + y.f) AS score, j
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.lp JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rp),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (
  SELECT b.* FROM b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.larger IS NULL OR 100::HUGEINT * i.larger < 80::HUGEINT * b.a)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM o JOIN n ON n.lang = o.lang QUALIFY rank <= 2000""")
def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
