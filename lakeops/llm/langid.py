"""Language identification by word-first backoff.

A word the model knows is scored by its log frequency in each language. An unseen word backs off to
its longest character n-grams the model knows, then to shorter ones, down to single characters. The
tables are bounded: so many words and n-grams of each order, those with the highest share in any
language. They are counted over a bounded sample of labelled rows a language, and kept as sorted
64-bit hashes with the languages each entry has, so neither size nor speed follows entries times languages.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeops.llm.common import query, stored, table, text_slices

WORDS = re.compile(r"[^\W\d_]+").findall
LONGEST = 5
FLUSH = 200_000
SHARE = 0.5  # added to every count


def words_of(text: str | None) -> Counter:
    """Lower-cased runs of letters with their counts."""
    found = Counter(WORDS(text.lower())) if text else Counter()
    odd = [word for word in found if not word.isalpha()]
    for word in odd:  # numerals that count as word characters
        n = found.pop(word)
        letters = "".join(filter(str.isalpha, word))
        if letters:
            found[letters] += n
    return found


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Table:
    """Log shares of entries by language, sparse: ``hashes`` sorted, of entry i the languages and how far their
    log share is above ``floor``, that of a language which never had the entry, from ``starts[i]`` on."""

    hashes: np.ndarray
    starts: np.ndarray
    langs: np.ndarray
    above: np.ndarray
    floor: np.ndarray

    def find(self, grams: list[str]) -> np.ndarray:
        """Place of each entry, -1 for unknown ones."""
        if not len(self.hashes) or not grams:
            return np.full(len(grams), -1)
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, grams), np.uint64, len(grams))
        at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashed, at, -1)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of some ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class Model:
    """tables[0] for words, tables[n] for n-grams of order n; arrays alone, so that a worker holds little."""

    languages: list[str]
    prior: np.ndarray
    tables: list[Table]

    def _vocabulary(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word the order it is scored by (-1: none), and its entries above the floor: ends, languages, values."""
        order = np.full(len(words), -1)
        owners, langs, values = [], [], []
        at = self.tables[0].find(words)
        owner, place = np.flatnonzero(at >= 0), at[at >= 0]
        order[owner] = 0
        for n in (0, *range(LONGEST, 0, -1)):
            found = self.tables[n]
            if n:
                left = np.flatnonzero(order < 0).tolist()
                grams = [grams_of(words[i], n) for i in left]
                owner = np.repeat(left, [len(g) for g in grams]).astype(np.int64)
                place = found.find([g for listed in grams for g in listed])
                owner, place = owner[place >= 0], place[place >= 0]
                order[owner] = n
            grams_each = np.bincount(owner, minlength=len(words))
            lengths = found.starts[place + 1] - found.starts[place]
            cells = _ranges(found.starts[place], lengths)
            owners.append(np.repeat(owner, lengths))
            langs.append(found.langs[cells])
            values.append(found.above[cells] / grams_each[owners[-1]])
        owner = np.concatenate(owners)
        by = np.argsort(owner, kind="stable")
        return order, np.cumsum(np.bincount(owner, minlength=len(words))), np.concatenate(langs)[by], np.concatenate(values)[by]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Of each text the best language and its share of the likelihood; ``und`` without letters or languages."""
        found = [words_of(text) if self.languages else Counter() for text in texts]
        ids = {word: i for i, word in enumerate(dict.fromkeys(word for counts in found for word in counts))}
        order, ends, langs, values = self._vocabulary(list(ids))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        floors = np.stack([t.floor for t in self.tables])
        out = []
        for counts in found:
            if not counts:
                out.append(("und", 0.0))
                continue
            words = np.fromiter((ids[word] for word in counts), np.int64, len(counts))
            times = np.fromiter(counts.values(), float, len(counts))
            known = order[words] >= 0
            total = self.prior + np.bincount(order[words][known], times[known], minlength=LONGEST + 1) @ floors
            lengths = ends[words] - starts[words]
            cells = _ranges(starts[words], lengths)
            total += np.bincount(langs[cells], np.repeat(times, lengths) * values[cells], minlength=len(self.languages))
            share = np.exp(total - total.max())
            best = int(share.argmax())
            out.append((self.languages[best], float(share[best] / share.sum())))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts by language, combined in the task up to a bounded number of entries."""
    counts: dict[str, Counter] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, found in counts.items() for word, n in found.items()]
        counts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"]
        )

    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            found = counts.setdefault(lang.as_py(), Counter())
            before = len(found)
            found.update(words_of(text.as_py()))
            size += len(found) - before
            if size >= FLUSH:
                yield flush()
                size = 0
    if counts:
        yield flush()


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts by language and order from word counts."""
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
            for order in range(1, LONGEST + 1):
                for gram in grams_of(word, order):
                    counts[lang, order, gram] += n
        rows = list(counts.items())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0][0] for r in rows], pa.string()),
                pa.array([r[0][1] for r in rows], pa.int32()),
                pa.array([r[0][2] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.int64()),
            ],
            names=["lang", "order", "gram", "n"],
        )


def train(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    rows_per_language: int = 1_500,
    most_entries: int = 100_000,
) -> Model:
    """A model from rows with a language and a text.

    Bounds, both parameters: about ``rows_per_language`` rows of each language, picked by a hash of key and
    text (rows repeated in full are in together or out together), and ``most_entries`` words and as many
    n-grams of each order. Every language is learned. Nulls are left out; without labelled rows the
    model answers ``und``.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(key).cast("string").alias("key"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    number = {r.lang: r.rows for r in sizes.collect()}
    languages = sorted(number)
    if not languages:
        return Model([], np.zeros(0), [_table([], [], languages, np.zeros(0)) for _ in range(LONGEST + 1)])
    place = F.pmod(F.xxhash64(F.coalesce("key", F.lit("")), "text", F.lit("langid")), F.lit(2**32))
    sample = rows.join(sizes, "lang").filter(place < F.least(F.lit(1.0), rows_per_language / F.col("rows")) * 2**32).select("lang", "text")
    counts = sample.mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "word-counts")
    grams = counts.mapInArrow(_grams, "lang string, order int, gram string, n long").groupBy("lang", "order", "gram").agg(F.sum("n").alias("n"))
    entries = counts.select("lang", F.lit(0).alias("order"), F.col("word").alias("gram"), "n").unionAll(grams)
    entries = stored(entries, "entries")
    totals = stored(entries.groupBy("lang", "order").agg(F.sum("n").alias("total")), "totals")
    sums = {(r.lang, r.order): r.total for r in totals.collect()}
    shares = entries.join(totals, ["lang", "order"]).withColumn("share", F.col("n") / F.col("total"))
    tables = []
    for order in range(LONGEST + 1):
        best = shares.filter(F.col("order") == order).groupBy("gram").agg(
            F.max("share").alias("share"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
        )
        top = best.orderBy(F.desc("share"), "gram").limit(most_entries).select("gram", F.map_keys("by").alias("langs"), F.map_values("by").alias("n")).toArrow()
        total = np.array([sums.get((name, order), 0) for name in languages], dtype=float) + SHARE * (top.num_rows + 1)
        tables.append(_table(top.column("gram").to_pylist(), [top.column(c).combine_chunks() for c in ("langs", "n")], languages, total))
    n = sum(number.values())
    return Model(languages, np.array([math.log(number[name] / n) for name in languages]), tables)


def _table(grams: list[str], cells: list[pa.Array], languages: list[str], total: np.ndarray) -> Table:
    floor = np.log(SHARE / total)
    if not grams:
        return Table(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32), floor)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, grams), np.uint64, len(grams))
    by = np.argsort(hashed)
    names, n = cells
    first = names.offsets.to_numpy().astype(np.int64)
    lengths = (first[1:] - first[:-1])[by]
    at = _ranges(first[:-1][by], lengths)
    place = {name: i for i, name in enumerate(languages)}
    langs = np.array([place[name] for name in names.values.to_pylist()], np.int32)[at]
    above = np.log((n.values.to_numpy()[at] + SHARE) / total[langs]) - floor[langs]
    return Table(hashed[by], np.concatenate([[0], np.cumsum(lengths)]), langs, above.astype(np.float32), floor)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns as a struct ``row``, with lang_pred and score (0 to 1). Only the text is looked at.

    ``und`` with score 0 where the text is null or has no letter. Whole texts are read, some millions of
    characters at a time; repeated rows get an answer each, equal likelihoods the first language by
    name; an empty table gives no rows, and other columns may have any name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [answer for _, part in text_slices(batch.column("text"), 2_000_000) for answer in shared.value.predict_all(part)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))
    schema = T.StructType([given.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return given.mapInArrow(run, schema)


def held_out(key: str | Column = "doc_id") -> Column:
    """Rows kept from training: crc32 of the key as text leaves 1 when divided by 3. A null key counts as empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def languages_of(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a model of those not held out."""
    model = train(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score"
    )


def with_language(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """The rows with a language: at least one letter, and a best language with ``min_score`` of the likelihood."""
    found = identify(docs, train(docs.filter(~held_out())))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select("row.*")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return languages_of(table(spark, folder, "documents"))
