import hashlib
import random
import re

import pytest

from lakeops.llm import repair

FIELDS = "conv_id long, turn long, role string, text string, place string, fault string, audit string"
SHAPE = re.compile(r"(s?(ua)+)?\Z")


def edits_by_force(codes):
    """The cheapest (cost, audit) over all edit sequences with up to three inserts in a row."""
    best = [(10**9, "")]

    def go(i, made, cost, audit):
        if cost > best[0][0]:
            return
        if i == len(codes):
            if SHAPE.match(made):
                best[0] = min(best[0], (cost, audit))
        else:
            extra = 3 * codes[i].isupper()
            go(i + 1, made, cost + 4, audit + "D")
            if codes[i] != "d":
                if codes[i].lower() in "sua":
                    go(i + 1, made + codes[i].lower(), cost + extra, audit + "K")
                for role in "ua":
                    go(i + 1, made + role, cost + extra + 3, audit + "R")
        if not audit.endswith("III"):
            for role in "ua":
                go(i, made + role, cost + 3, audit + "I")

    go(0, "", 0, "")
    return best[0]


def cheapest(codes):
    ways = repair.parse(codes)
    ends = repair.ended(ways)
    return min((ways[v][0] + ends[v][0], ways[v][1] + ends[v][1]) for v in ends)


def test_parse_equals_brute_force():
    r = random.Random(4)
    for _ in range(250):
        codes = "".join(r.choice("ddsuaxSUAXuauaua") for _ in range(r.randint(0, 5)))
        assert cheapest(codes) == edits_by_force(codes)


def expected(turns):
    """(blank, duplicate, truncated, illegal, cost, audit) of ordered (role, text) turns, by one parse."""
    seen, codes, counts = set(), "", {"b": 0, "d": 0, "t": 0}
    for role, text in turns:
        told = text.strip(" \t\n\x0b\f\r")
        fault = "b" if not told else "d" if (role, text) in seen else "t" if told[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] = counts.get(fault, 0) + 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        codes += "d" if fault in ("b", "d") else initial.upper() if fault else initial
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return (counts["b"], counts["d"], counts["t"], illegal, *cheapest(codes))


def random_rows(r, conv, n):
    said = ["a.", "b", "", "c!", "d? ", " \n", None, "long text", "e."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None]
    return [(conv, r.choice([None, k, k, k]), r.choice(roles), r.choice([r.choice(said), f"{k} {r.choice(said)}"]), "x", "y", "z") for k in range(n)]


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_blocks_of_any_length_give_the_same_repair(spark, monkeypatch, bits):
    r = random.Random(9)
    rows = [row for conv, n in ((1, 1), (2, 7), (3, 40), (None, 6), (5, 150)) for row in random_rows(r, conv, n)]
    rows += [(6, 0, "user", "same.", "", "", "")] * 2 + [(6, 1, "assistant", "fine.", "", "", "")]
    monkeypatch.setattr(repair, "BITS", bits)
    report, lines = repair.repair(spark.createDataFrame(rows, FIELDS).repartition(3))
    got = {x.conv_id: x for x in report.collect()}
    texts = {}
    for x in sorted(lines.collect(), key=lambda x: (x.place, x.at)):
        texts.setdefault(x.conv_id, []).append((x.role, x.text))
    for conv in {row[0] for row in rows}:
        own = sorted(((t if t is not None else -1, role or " ", " " if text is None else text) for c, t, role, text, *_ in rows if c == conv), key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        want = expected([x[1:] for x in own])
        row = got[conv]
        assert (row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit) == want
        turns = [x[0] for x in own if x[0] >= 0]
        assert row.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert SHAPE.match("".join(role[0] for role, _ in texts.get(conv, [])))
        kept = iter(x[1:] for x in own)
        made = []
        for edit in row.audit:
            if edit == "I":
                made.append("")
            else:
                text = next(kept)[1]
                made += [text] * (edit != "D")
        assert [text for _, text in texts.get(conv, [])] == made


def test_edges(spark):
    empty = hashlib.sha256().hexdigest()
    none = spark.createDataFrame([], FIELDS)
    assert repair.repaired_digests(none).count() == 0
    # crc32("0:1") % 20 and others decide; a conversation of nulls alone is blank text.
    rows = spark.createDataFrame([(None, None, None, None, "", "", ""), (8, None, "assistant", "x" * 200_000 + ".", "", "", "")], FIELDS)
    got = {x.conv_id: x for x in repair.repaired_digests(rows).collect()}
    assert set(got) == {None, 8} and got[None].repaired_sha256 == empty and got[None].cost in (0, 4)
    report, lines = repair.repair(rows)
    assert {x.conv_id: x.audit for x in report.collect()} == {None: "D", 8: "IK"}
    assert [(x.role, len(x.text)) for x in sorted(lines.collect(), key=lambda x: x.at)] == [("user", 0), ("assistant", 200_001)]
