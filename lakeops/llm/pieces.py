"""Byte-pair encoding and decoding with a sentence-piece model file, in vectorised merge rounds.

All distinct words of a batch lie in one flat array of symbols. A round finds the smallest pair rank
of every word, merges its occurrences from left to right in all words at once and closes the gaps;
words without a known pair leave the array. A word merges several occurrences in one round only as
far as the sequential order would: up to the first merge that makes a pair of equal or better rank.
The model file is read here; the library that made it is needed in tests only.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.llm.common import query, table, text_slices

SPACE = "▁"
FAR = np.int64(2**62)
SHIFT = 22
#: Distinct words a worker keeps with their ids before it starts anew.
KNOWN_WORDS = 200_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message: varints, 8, 4 or length-prefixed bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size


class Pieces:
    """Tables of a BPE model: ids of characters, ranked pairs, texts of ids. Kinds it can't follow exactly are refused."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            top = list(_fields(file.read()))
        self.names, scores, kinds = [], [], []
        for number, value in top:
            if number == 1:
                piece = dict(_fields(value))
                self.names.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, 1))
        trainer = dict(_fields(next((v for n, v in top if n == 2), b"")))
        cleaner = dict(_fields(next((v for n, v in top if n == 3), b"")))
        if trainer.get(3, 1) != 2 or cleaner.get(2) or cleaner.get(4, 1) or not cleaner.get(5, 1) or {4, 5} & set(kinds):
            raise ValueError("only BPE models with identity normalisation and plain, byte and control pieces")
        self.prefix = bool(cleaner.get(3, 1))
        self.size = len(self.names)
        self.kinds = np.array(kinds)
        self.unknown = kinds.index(2)
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(self.size) if kinds[i] == 6} if trainer.get(35, 0) else {}
        plain = {self.names[i]: i for i in range(self.size) if kinds[i] == 1}
        self.by_word = not any(SPACE in name.lstrip(SPACE) for name in plain)
        self.chars = np.arange(0x110000, dtype=np.int64) + self.size
        for name, i in plain.items():
            if len(name) == 1:
                self.chars[ord(name)] = i
        # Symbols in a merge are pieces or single characters.
        symbol = lambda s: plain.get(s, self.size + ord(s) if len(s) == 1 else None)
        pairs = []
        for name, i in plain.items():
            for cut in range(1, len(name)):
                a, b = symbol(name[:cut]), symbol(name[cut:])
                if a is not None and b is not None:
                    pairs.append((a << SHIFT | b, i))
        order = {score: rank for rank, score in enumerate(sorted(set(scores), reverse=True))}
        pairs.sort()
        self.keys = np.array([key for key, _ in pairs], dtype=np.int64)
        self.merged = np.array([i for _, i in pairs], dtype=np.int64)
        self.ranks = np.array([order[scores[i]] for _, i in pairs], dtype=np.int64)
        # Control pieces decode to nothing, an unknown id to its fixed surface.
        surface = {1: lambda s: s.replace(SPACE, " "), 2: lambda s: " ⁇ ", 3: lambda s: "", 6: lambda s: None}
        self.texts = [surface[kind](name) for name, kind in zip(self.names, kinds, strict=True)]

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of the pairs; FAR where there is none."""
        if not len(self.keys):
            return np.full(len(a), FAR), np.full(len(a), -1)
        key = a << SHIFT | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], FAR), np.where(found, self.merged[at], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and how many each word has."""
        lengths = np.array([len(word) for word in words], dtype=np.int64)
        symbols = self.chars[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        owner = np.repeat(np.arange(len(words)), lengths)

        def ranked(where: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            rank, piece = self.look_up(left, right)
            return np.where(where, rank, FAR), piece

        def next_in_word(owner: np.ndarray) -> np.ndarray:
            return np.append(owner[1:] == owner[:-1], False) if len(owner) else np.zeros(0, bool)

        rank, piece = ranked(next_in_word(owner), symbols, np.append(symbols[1:], 0)) if len(symbols) else (symbols, symbols)
        done_symbols, done_owner = [], []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(starts, len(owner)))
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = best == FAR
            if over.any():
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                symbols, owner, rank, piece, best = (x[~over] for x in (symbols, owner, rank, piece, best))
                if not len(symbols):
                    break
            hit = rank == best
            # Of overlapping occurrences every second one, from the left of each run.
            index = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), index, 0))
            chosen = np.flatnonzero(hit & ((index - run) % 2 == 0))
            # The sequential order goes on to the next occurrence unless a merge makes a pair as good.
            made, word = piece[chosen], owner[chosen]
            left = np.maximum(chosen - 1, 0)
            after_merge = np.append(False, chosen[1:] == chosen[:-1] + 2)
            before = np.where(after_merge, np.append(0, made[:-1]), symbols[left])
            has_left = (chosen > 0) & (owner[left] == word)
            right = np.minimum(chosen + 2, len(symbols) - 1)
            has_right = (chosen + 2 < len(symbols)) & (owner[right] == word)
            new = np.minimum(ranked(has_left, before, made)[0], ranked(has_right, made, symbols[right])[0])
            stop = new <= best[chosen]
            if stop.any():
                first = np.append(True, word[1:] != word[:-1])
                stopped = np.cumsum(stop) - stop
                base = np.maximum.accumulate(np.where(first, stopped, 0))
                chosen = chosen[stopped - base == 0]
            symbols = symbols.copy()
            symbols[chosen] = piece[chosen]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            stale = np.zeros(len(symbols), bool)
            stale[chosen] = True
            symbols, owner, rank, piece, stale = (x[keep] for x in (symbols, owner, rank, piece, stale))
            stale |= np.append(stale[1:], False)
            at = np.flatnonzero(stale)
            right = np.minimum(at + 1, len(symbols) - 1)
            rank[at], piece[at] = ranked((at + 1 < len(symbols)) & (owner[right] == owner[at]), symbols[at], symbols[right])
        if not done_symbols:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        symbols, owner = symbols[order], owner[order]
        strange = np.flatnonzero(symbols >= self.size)
        if len(strange):  # characters without a piece: their bytes, or the unknown id
            spelled = [
                [self.bytes[b] for b in chr(s - self.size).encode()] if self.bytes else [self.unknown] for s in symbols[strange].tolist()
            ]
            repeat = np.ones(len(symbols), np.int64)
            repeat[strange] = [len(x) for x in spelled]
            at = np.cumsum(repeat) - repeat
            symbols, owner = np.repeat(symbols, repeat), np.repeat(owner, repeat)
            for start, ids in zip(at[strange].tolist(), spelled, strict=True):
                symbols[start : start + len(ids)] = ids
        return symbols, np.bincount(owner, minlength=len(words))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: word marks as spaces, runs of byte pieces as UTF-8, without the prefix space."""
        parts, texts = [], self.texts
        pending = bytearray()
        for i in ids:
            text = texts[i]
            if text is None:
                pending.append(int(self.names[i][3:5], 16))
                continue
            if pending:
                parts.append(_utf8(pending))
                pending = bytearray()
            parts.append(text)
        if pending:
            parts.append(_utf8(pending))
        whole = "".join(parts)
        first = next((i for i in ids if self.kinds[i] != 3), None)
        return whole[1:] if self.prefix and first is not None and self.kinds[first] == 1 and whole.startswith(" ") else whole


def _utf8(data: bytearray) -> str:
    """Whole characters, and U+FFFD for each byte that is part of none."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Encoder:
    """Encodes texts batch by batch; remembers the ids of a bounded number of words."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each text has."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        known, fresh, order, sizes = self.known, [], [], []
        for text in texts:
            line = text.replace(" ", SPACE)
            line = SPACE + line if line and self.pieces.prefix else line
            words = self.split(line) if self.pieces.by_word else [line] * bool(line)
            for word in set(words):
                if word not in known:
                    known[word] = len(known)
                    fresh.append(word)
            order.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            sizes.append(len(words))
        if fresh:
            ids, counts = self.pieces.merge(fresh)
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(counts) - counts])
            self.flat, self.count = np.concatenate([self.flat, ids]), np.concatenate([self.count, counts])
        words = np.concatenate(order) if order else np.zeros(0, np.int64)
        counts = self.count[words]
        ends = np.cumsum(counts)
        ids = self.flat[np.repeat(self.start[words] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.append(0, ends)[np.append(0, np.cumsum(sizes)).astype(np.int64)]
        return ids, np.diff(edges)


def tokenize(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """All rows and columns as a struct ``row``, with ids array<int> and decoded, the text of the ids.

    ``model`` is the path of a model file on the driver; its tables (a few MB, fixed by the file) go
    to the tasks. A null text is empty and has no ids. Whole texts, any length.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(Pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces.value)
        for batch in batches:
            for start, part in text_slices(batch.column("text")):
                ids, counts = encoder.encode(part)
                edges = np.append(0, np.cumsum(counts)).astype(np.int32)
                decoded = [pieces.value.decode(ids[a:b].tolist()) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(start, len(part)),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32))),
                        pa.array(decoded, pa.string()),
                    ],
                    names=["row", "ids", "decoded"],
                )

    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))
    schema = T.StructType([given.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return given.mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return tokenize(docs.select("doc_id", "text"), model or default_model()).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"))
