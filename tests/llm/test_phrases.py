import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeops.llm import phrases

FIELDS = "lang string, text string, phrase string, total long"


def by_force(rows, least, share, most):
    """All phrases counted in dictionaries."""
    f, n = defaultdict(Counter), Counter()
    for lang, text, *_ in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for part in {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1)} - {p}:
                inside[part] = max(inside[part], a)
        found = []
        for p, a in candidates.items():
            if 100 * inside[p] >= share * a:
                continue
            score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(spark, rows, **options):
    found = phrases.collocations(spark.createDataFrame(rows, FIELDS).repartition(3), **options)
    return sorted(tuple(r) for r in found.collect())


def texts(seed):
    r = random.Random(seed)
    said = ["New York city", "new York", "a b c d e", "Straße ÉTE", "the the the the", "the", "x y z", "end. New\tyork", "a b\nc d", "hot dog!", "\x1c a b", ""]
    return [(r.choice(["en", "de", None]), " ".join(r.choice(said) for _ in range(r.randint(0, 30))), "x", 1) for _ in range(150)]


@pytest.mark.parametrize("least, share, most", [(30, 80, 2_000), (5, 60, 7), (200, 100, 3)])
def test_equal_to_brute_force(spark, least, share, most):
    rows = [*texts(least), ("en", None, "", 1), ("fr", "", "", 1), ("fr", "one two " * 20_000, "", 2)]
    rows += rows[:40]
    assert got(spark, rows, least=least, share=share, most=most) == by_force(rows, least, share, most)


def test_hot_prefixes_in_slices_and_a_full_filter(spark, monkeypatch):
    rows = texts(1)
    want = by_force(rows, 5, 80, 2_000)
    # Functions are sent to the workers with what they read from the module, so these are set there too.
    assert phrases.Known().slices == {}
    monkeypatch.setattr(phrases, "LEAST_HOT", 10)
    known = phrases.known_of(spark.createDataFrame([("en", "the", 55), ("en", "a", 3)], "lang string, phrase string, f long"), 100)
    assert known.slices == {("en", "the"): 6}
    assert got(spark, rows, least=5) == want
    full = phrases.Known(known.bits | ~known.bits, known.slices)
    words, codes = phrases.coded(phrases.tokens_of(["the cat the dog. the", "a b"]))
    parts = phrases.stripes_of("en", words, codes, 1, full).to_pylist()
    merged = defaultdict(Counter)
    for part in parts:
        merged[part["prefix"]].update(dict(zip(part["next"].split(), part["n"])))
    assert merged == {"the": {"cat": 1, "dog": 1, ".": 1}, "cat": {"the": 1}, "dog": {".": 1}, "a": {"b": 1}, "b": {".": 1}}


def test_no_rows(spark):
    assert got(spark, []) == [] and got(spark, [("en", "a b", "", 1), (None, None, "", 1)]) == []


def test_stripes_are_shuffled_in_bundles(spark, monkeypatch):
    rows, dealt, frame = texts(2), [], type(spark.range(1))
    plain = frame.sortWithinPartitions

    def counted(df, *keys):
        dealt.append(df.count())
        return plain(df, *keys)

    monkeypatch.setattr(frame, "sortWithinPartitions", counted)
    monkeypatch.setattr(phrases, "LEAST_BITS", 2)
    assert got(spark, rows, least=5) == by_force(rows, 5, 80, 2_000)
    # Three parts with three languages each, in four ranges.
    assert len(dealt) == 4 and all(0 < n <= 3 * 3 * 4 for n in dealt)


def test_bundles_hold_their_stripes():
    words, codes = phrases.coded(phrases.tokens_of(["Straße the cat the dog. the", "a b\x1c \x1c"]))
    for width in (0, 1, 2):
        full = phrases.Known(np.full(2 ** (phrases.BITS - 6), 2**64 - 1, np.uint64), {("en", "the"): 3})
        made, hashed = phrases._hashed_stripes("en", words, codes, width, full)
        bundles = phrases.bundles_of(made, hashed, 3)
        assert bundles.num_rows == len(set((hashed >> np.uint64(61)).tolist())) <= 8
        merged, whole = defaultdict(Counter), defaultdict(Counter)
        for part in phrases._merged(1)(iter([bundles])):
            for r in part.to_pylist():
                merged[r["prefix"]].update(dict(zip(r["next"], r["n"])))
        for r in made.to_pylist():
            whole[r["prefix"]].update({w: n for w, n in zip(r["next"].split(" "), r["n"]) if w != "."})
        assert {k: v for k, v in merged.items() if v} == {k: v for k, v in whole.items() if v}
