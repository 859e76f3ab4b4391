import math
import random
import zlib
from collections import Counter

import pytest

from lakeops.llm import suffix_tree
from lakeops.llm.registry import QUERIES
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
FIELDS = "doc_id long, text string, score string, row long"


class Tree:
    """The same model with dictionaries, all in memory."""

    def __init__(self, texts, depth, least_context, least_next):
        self.depth, self.least_context, self.least_next = depth, least_context, least_next
        self.count = Counter()
        for text in texts:
            words = ["<", *suffix_tree.words_of(text)]
            for i in range(len(words)):
                for k in range(1, min(depth + 1, i + 1) + 1):
                    self.count[tuple(words[i - k + 1 : i + 1])] += 1
        self.words = sum(n for gram, n in self.count.items() if len(gram) == 1 and gram != ("<",))
        self.distinct = sum(len(gram) == 1 and gram != ("<",) for gram in self.count)
        self.states = {}
        following = {}
        for gram, n in self.count.items():
            if len(gram) > 1 and n >= least_next:
                following.setdefault(gram[:-1], []).append((gram[-1], n))
        for context, told in following.items():
            n = self.count[context]
            if len(context) > depth or n < least_context:
                continue
            shorter = self.count[context[1:]] if len(context) > 1 else self.words
            ratio = sum(c * math.log(c / n / (self.count[(*context[1:], w)] / shorter)) for w, c in told)
            if ratio > 0.5 * len(told) * math.log(max(n, 2)):
                self.states[context] = (sum(c for _, c in told), len(told))

    def p(self, before, word):
        value = (self.count[(word,)] + 0.5) / (self.words + 0.5 * (self.distinct + 1))
        for d in range(1, self.depth + 1):
            context = tuple(before[-d:])
            if len(context) == d and context in self.states:
                total, different = self.states[context]
                n, c = self.count[context], self.count[(*context, word)]
                value = ((c if c >= self.least_next else 0) + (n - total + different) * value) / (n + different)
        return value

    def scores(self, text):
        words = ["<", *suffix_tree.words_of(text)]
        base = sum(math.log10((self.count[(w,)] + 0.5) / (self.words + 0.5 * (self.distinct + 1))) for w in words[1:])
        return len(words) - 1, sum(self.count[(w,)] > 0 for w in words[1:]), base, sum(math.log10(self.p(words[:i], words[i])) for i in range(1, len(words)))


def same(got, want):
    assert got[:2] == want[:2]
    assert got[2:] == pytest.approx(want[2:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("depth, block", [(2, 500_000), (2, 37), (1, 5), (3, 64)])
def test_scores_equal_brute_force(spark, depth, block):
    r = random.Random(depth)
    said = ["the cat sat on the mat", "a dog ran", "The cat ran\ton", "on a mat x"]
    rows = [(i, " ".join(r.choice(said) for _ in range(r.randint(0, 12))), "x", 1) for i in range(60)]
    rows += [(70, None, "", 2), (70, "", "", 2), (None, "the cat", "", 2), (71, "the cat " * 200, "", 2), (71, "the cat " * 200, "", 2)]
    docs = spark.createDataFrame(rows, FIELDS).repartition(3)
    learned = [text for key, text, *_ in rows if zlib.crc32(str("" if key is None else key).encode()) % 5 != 1]
    tree = Tree(learned, depth, 8, 2)
    assert tree.states
    found = suffix_tree.suffix_tree_scores(docs, ~suffix_tree.held_out(), depth=depth, least_context=8, block=block).collect()
    assert len(found) == len(rows)
    wanted = sorted(((str(key), tree.scores(text)) for key, text, *_ in rows), key=str)
    for row, (key, want) in zip(sorted(found, key=lambda x: str((str(x.doc_id), (x.n_tokens, x.n_known, x.base_score)))), wanted, strict=True):
        assert str(row.doc_id) == key and row.train_tokens == tree.words
        same((row.n_tokens, row.n_known, row.base_score, row.score), want)


def test_probabilities_add_up_to_one():
    tree = Tree(["a b a b a c"] * 9 + ["c a b"], 2, 4, 2)
    vocabulary = [gram[0] for gram in tree.count if len(gram) == 1 and gram != ("<",)] + ["unseen"]
    for before in (["<"], ["<", b"a"], [b"a", b"b"], [b"b", b"a"], [b"new", b"c"]):
        assert sum(tree.p(before, w) for w in vocabulary) == pytest.approx(1)


def test_given_documents(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    tree = Tree([t for k, t in rows.items() if zlib.crc32(str(k).encode()) % 5 != 1], 2, 20, 2)
    found = QUERIES["op12_suffix_tree"](spark, FOLDER).collect()
    assert {r.doc_id for r in found} == set(rows)
    for r in found:
        same((r.n_tokens, r.n_known, r.base_score, r.score), tree.scores(rows[r.doc_id]))
        assert r.train_tokens == tree.words and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(spark):
    none = spark.createDataFrame([], FIELDS)
    assert suffix_tree.suffix_tree_scores(none, ~suffix_tree.held_out()).count() == 0
    rows = spark.createDataFrame([(1, "a b", "", 0), (None, None, "", 0)], FIELDS)
    found = {r.doc_id: r for r in suffix_tree.suffix_tree_scores(rows, F.lit(False)).collect()}
    assert [(found[k].n_tokens, found[k].n_known, found[k].train_tokens, found[k].score) for k in (1, None)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]


def test_contexts_are_tested_a_length_a_round(spark, monkeypatch):
    levels, plain = {}, suffix_tree.stored

    def stored(df, label):
        out = plain(df, label)
        if "level" in out.columns:
            levels[label] = {r.level for r in out.select("level").distinct().collect()}
        return out

    monkeypatch.setattr(suffix_tree, "stored", stored)
    docs = spark.createDataFrame([(i, "the cat sat on the mat " * 5, "", 0) for i in range(30)], FIELDS)
    assert suffix_tree.suffix_tree_scores(docs, F.lit(True)).count() == 30
    # No table holds the tests of both lengths.
    assert sorted(map(sorted, levels.values())) == [[1], [2], [3, suffix_tree.TEST + 1], [suffix_tree.TEST + 2]]
