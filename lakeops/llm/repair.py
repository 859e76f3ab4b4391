"""Repair of conversation structure: generalised LR parsing with weighted edits.

The grammar over role initials is ``(s?(ua)+)?``. Its SLR tables drive a graph-structured stack: a
vertex is a state on top of a vertex, made once, so equal stacks are one vertex, and of the ways that
lead to it the one with the smallest (cost, audit) stands. Keeping, re-roling and inserting shift a
role, after the reductions that the role allows; deleting leaves the stack as it is. Inserts come
before a turn or after the last one, so two audits of the same turns never begin one another, and the
smaller prefix stays the smaller one whatever follows.

A conversation may be long: its turns are ordered by range, cut into blocks, and each block is parsed
from every stack it may begin with, in parallel. What is folded along a conversation is a few costs and
letters a block, never its texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.common import BLANKS, query, stored, table

#: Left-recursive, so the stack stays flat.
GRAMMAR = [("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua")]
FOLLOW = {"S": "$", "P": "$u"}
LEGAL = {"su", "ua", "au"}
RESULT = {"u": "user", "a": "assistant"}
RETYPE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: 2 ** BITS places in the order of all turns make a block.
BITS = 10

Vertex = tuple  # (state, vertex below or None)
Ways = dict[Vertex, tuple]  # the best way to each stack


def _closed(items: frozenset) -> frozenset:
    """LR items (rule, dot) with those of the nonterminals behind a dot."""
    while True:
        wanted = {GRAMMAR[rule][1][dot] for rule, dot in items if dot < len(GRAMMAR[rule][1])}
        more = items | {(k, 0) for k, (left, _) in enumerate(GRAMMAR) if left in wanted}
        if more == items:
            return items
        items = more


@cache
def _goto(state: frozenset, symbol: str) -> frozenset | None:
    moved = frozenset((rule, dot + 1) for rule, dot in state if GRAMMAR[rule][1][dot : dot + 1] == symbol)
    return _closed(moved) if moved else None


START: Vertex = (_closed(frozenset((k, 0) for k, (left, _) in enumerate(GRAMMAR) if left == "S")), None)


@cache
def _reduced(vertex: Vertex, ahead: str) -> tuple[Vertex, ...]:
    """The vertex and those that reductions allowed before ``ahead`` lead to."""
    found, todo = [], [vertex]
    while todo:
        at = todo.pop()
        found.append(at)
        for rule, dot in at[0]:
            left, right = GRAMMAR[rule]
            if dot == len(right) and ahead in FOLLOW[left] and left != "S":
                below = at
                for _ in right:
                    below = below[1]
                todo.append((_goto(below[0], left), below))
    return tuple(found)


@cache
def _shifted(vertex: Vertex, role: str) -> Vertex | None:
    for at in _reduced(vertex, role):
        state = _goto(at[0], role)
        if state is not None:
            return (state, at)
    return None


@cache
def _accepts(vertex: Vertex) -> bool:
    """Whether the end may follow: some rule of S is complete on the whole stack."""
    for at in _reduced(vertex, "$"):
        for rule, dot in at[0]:
            left, right = GRAMMAR[rule]
            below = at
            for _ in range(dot):
                below = below[1]
            if left == "S" and dot == len(right) and below == START:
                return True
    return False


@cache
def _inserted(vertex: Vertex) -> tuple[tuple[Vertex, int], ...]:
    """Stacks within reach by inserting roles, with the fewest inserts."""
    reach, edge = {vertex: 0}, [vertex]
    while edge:
        edge = [to for at in edge for role in "ua" if (to := _shifted(at, role)) and reach.setdefault(to, reach[at] + 1) == reach[at] + 1]
        edge = [at for at in dict.fromkeys(edge) if reach[at] < 4]
    return tuple(reach.items())


def _all_stacks() -> list[Vertex]:
    found, todo = [START], [START]
    while todo:
        at = todo.pop()
        for role in "sua":
            to = _shifted(at, role)
            if to and to not in found:
                found.append(to)
                todo.append(to)
    return found


STACKS = _all_stacks()


def parse(codes: str, start: Vertex = START) -> Ways:
    """(cost, audit) of the cheapest edits to each stack after the turns, from a stack.

    A code is the initial of a role that the grammar knows or ``x``, a capital where the text is cut
    off; ``d`` is a turn that has to go.
    """
    ways: Ways = {start: (0, "")}
    for code in codes:
        after: Ways = {}

        def put(to: Vertex | None, way: tuple, after: Ways = after) -> None:
            if to is not None and (to not in after or way < after[to]):
                after[to] = way

        role, extra = code.lower(), CUT_OFF * code.isupper()
        for vertex, (cost, audit) in ways.items():
            for at, n in _inserted(vertex):
                paid, said = cost + INSERT * n, audit + "I" * n
                put(at, (paid + DELETE, said + "D"))
                if code != "d":
                    put(_shifted(at, role), (paid + extra, said + "K"))
                    for new in "ua":
                        put(_shifted(at, new), (paid + extra + RETYPE, said + "R"))
        ways = after
    return ways


def ended(ways: Ways) -> dict[Vertex, tuple[int, str]]:
    """Of each stack the cheapest (cost, inserts) that make the end possible."""
    found = {}
    for vertex in ways:
        ends = [(INSERT * n, "I" * n) for at, n in _inserted(vertex) if _accepts(at)]
        if ends:
            found[vertex] = min(ends)
    return found


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of turns with the ways through them: stack before, stack after, cost, audit."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    number = {vertex: k for k, vertex in enumerate(STACKS)}
    for batch in batches:
        found = []
        for codes, first in zip(batch.column("codes").to_pylist(), batch.column("opens").to_pylist(), strict=True):
            starts = STACKS[:1] if first else STACKS
            found.append([{"a": number[s], "b": number[e], "cost": c, "audit": t} for s in starts for e, (c, t) in parse(codes, s).items()])
        rest = [batch.column(name) for name in ("conv_id", "first", "initials")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(found, kind)], names=["conv_id", "first", "initials", "ways"])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest way along each conversation, block by block in order: a row a block with its part of
    the audit, the turns made before it and whether a system turn leads; cost, audit and illegal pairs
    in the row of the first block."""
    names = ["conv_id", "first", "audit", "before", "led", "tail", "cost", "illegal", "whole"]
    schema: pa.Schema | None = None
    conv, ways, firsts, last, illegal = None, {}, [], "", 0

    def closed() -> pa.RecordBatch:
        ends = ended(dict.fromkeys(STACKS[k] for k in ways))
        found = [(cost + ends[STACKS[k]][0], rank, ends[STACKS[k]][1], node) for k, (cost, rank, node) in ways.items() if STACKS[k] in ends]
        cost, rank, tail, node = min(found, key=lambda way: way[:3])
        parts = []
        while node:
            parts.append(node[1])
            node = node[0]
        parts = parts[::-1]
        whole, made, rows = "".join(parts) + tail, 0, []
        total = len(whole) - whole.count("D")
        for k, (first, part) in enumerate(zip(firsts, parts, strict=True)):
            extra = [cost, illegal, whole] if k == 0 else [None] * 3
            rows.append([conv, first, part, made, total % 2 == 1, tail if k == len(parts) - 1 else "", *extra])
            made += len(part) - part.count("D")
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), schema.types, strict=True)], names=names)

    for batch in batches:
        if schema is None:
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            schema = pa.schema(list(zip(names, kinds, strict=True)))
        for key, first, initials, steps in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "first", "initials", "ways")), strict=True):
            if not firsts or key != conv:
                if firsts:
                    yield closed()
                conv, ways, firsts, last, illegal = key, {0: (0, 0, None)}, [], "", 0
            illegal += sum(a + b not in LEGAL for a, b in pairwise(last + initials))
            last = initials[-1:]
            firsts.append(first)
            # Audits up to here never begin one another, so their order is that of (rank before, part).
            best: dict[int, tuple] = {}
            for step in steps:
                if step["a"] in ways:
                    cost, rank, node = ways[step["a"]]
                    new = (cost + step["cost"], rank, step["audit"], node)
                    if step["b"] not in best or new[:3] < best[step["b"]][:3]:
                        best[step["b"]] = new
            order = {said: k for k, said in enumerate(sorted({(rank, audit) for _, rank, audit, _ in best.values()}))}
            ways = {b: (cost, order[rank, audit], (node, audit)) for b, (cost, rank, audit, node) in best.items()}
    if firsts:
        yield closed()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stands in place of each turn: roles in order, null for its own, and which of them has its text."""
    for batch in batches:
        places, roles, own = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("first", "audit", "before", "led", "tail"))
        for first, audit, made, led, tail in zip(*columns, strict=True):
            said = re.findall("I*[KRD]", audit)
            for k, edits in enumerate(said):
                edits += tail if k == len(said) - 1 else ""
                listed, mine = [], -1
                for edit in edits:
                    if edit in "KR":
                        mine = len(listed)
                    if edit != "D":
                        listed.append(None if edit == "K" else RESULT["ua"[(made - led) % 2]])
                        made += 1
                places.append(first + k)
                roles.append(listed)
                own.append(mine)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(roles, pa.list_(pa.string())), pa.array(own, pa.int32())], names=["place", "roles", "own"])


def ordered_turns(rows: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text, place) with their faults, stored. ``place`` orders all turns: those
    of a conversation follow one another by turn (nulls first), then role and text."""
    given = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    # Ranges may cut a conversation, and even the rows of one turn.
    ranged = given.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(32))).sortWithinPartitions("conv_id", "turn", "role", "text")
    placed = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "turns")
    firsts = placed.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("is_first"))
    told = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(told == "", "blank").when(F.col("is_first").isNull(), "duplicate").when(~F.right(told, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    return stored(placed.join(firsts, "place", "left").withColumn("fault", fault).drop("is_first"), "faults")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations' report and their repaired turns.

    ``rows``: conv_id, turn, role, text; other columns are ignored. Report: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit. Turns: conv_id, place, at, role, text, in the order of
    (place, at); inserted ones have an empty text.

    A null role or text is one space; null turns come first, equal turns go by role and text; rows
    without a conv_id are one conversation. A conversation whose turns all go has no repaired turn; an
    empty table gives two empty ones.
    """
    turns = ordered_turns(rows)
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    count = lambda fault: F.count_if(F.coalesce(F.col("fault") == fault, F.lit(False))).alias(fault)
    totals = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *map(count, ("blank", "duplicate", "truncated")), F.min("place").alias("opening"),
    )
    totals = stored(totals, "conversations")
    listed = F.array_sort(F.collect_list(F.struct("place", code.alias("code"), initial.alias("initial"))))
    blocks = turns.groupBy("conv_id", F.shiftright("place", BITS).alias("block")).agg(listed.alias("l"))
    joined = lambda field: F.array_join(F.transform("l", lambda x: x[field]), "")
    blocks = blocks.select("conv_id", F.col("l")[0]["place"].alias("first"), joined("code").alias("codes"), joined("initial").alias("initials"))
    opens = totals.select(F.col("opening").alias("first"), F.lit(True).alias("opens"))
    blocks = blocks.join(opens, "first", "left").withColumn("opens", F.coalesce("opens", F.lit(False)))
    kind = turns.schema["conv_id"].dataType.simpleString()
    ways = blocks.mapInArrow(_parsed, f"conv_id {kind}, first long, initials string, ways array<struct<a: int, b: int, cost: long, audit: string>>")
    ways = ways.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    folded = ways.mapInArrow(
        _folded, f"conv_id {kind}, first long, audit string, before long, led boolean, tail string, cost long, illegal long, whole string"
    )
    folded = stored(folded, "folded")
    parsed = folded.filter("whole IS NOT NULL").select(F.col("first").alias("opening"), "cost", "illegal", F.col("whole").alias("audit"))
    report = totals.join(parsed, "opening").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edits = folded.mapInArrow(_edited, "place long, roles array<string>, own int")
    lines = turns.join(edits, "place").select("conv_id", "place", F.posexplode("roles").alias("at", "new"), "own", "role", "text")
    text = F.when(F.col("at") == F.col("own"), F.col("text")).otherwise("")
    return report, lines.select("conv_id", "place", "at", F.coalesce("new", "role").alias("role"), text.alias("text"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a conversation over ``role:text`` lines in order, read as a stream."""
    digest, conv = None, None
    for batch in batches:
        keys, digests = [], []
        for key, line in zip(batch.column("conv_id").to_pylist(), batch.column("line"), strict=True):
            if digest is None or key != conv:
                if digest is not None:
                    keys.append(conv)
                    digests.append(digest.hexdigest())
                digest, conv = hashlib.sha256(), key
            else:
                digest.update(b"\n")
            digest.update(line.as_py().encode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field("conv_id").type), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])
        kind = batch.schema.field("conv_id").type
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with the faults that the crc32 of ``conv_id:turn`` picks; nulls are one space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    which = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("which") == 1, "").when(F.col("which") == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(F.col("which") == 4, "user").otherwise(spaced("role"))
    times = F.when(F.col("which") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    picked = rows.select("conv_id", "turn", "role", "text", which.alias("which")).filter("which <> 0")
    return picked.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.explode(times).alias("_time")).drop("_time")


#: Edits of one turn, or of the end, by the automaton of the grammar: state, code, state after, cost, letters.
_MOVES = """
  SELECT * FROM (VALUES ('E','s','S'),('E','u','U'),('S','u','U'),('U','a','A'),('A','u','U')) g(f, r, t)"""


@query("op11_repair", sql=rf"""
WITH RECURSIVE g AS ({_MOVES}),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
c AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(key, ''), lambda x: unicode(x)::UBIGINT)),
     lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, o: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) % 20 AS w FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN w = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN w = 1 THEN '' WHEN w = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM c, range(2) n(i) WHERE w <> 0 AND (i = 0 OR w = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
e AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault, left(role, 1) AS r,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM o),
x AS (
  SELECT f, t, '' AS ins, 0 AS n FROM (VALUES ('E','E'),('S','S'),('U','U'),('A','A')) v(f, t)
  UNION ALL SELECT f, t, 'I', 1 FROM g WHERE r <> 's'
  UNION ALL SELECT a.f, b.t, 'II', 2 FROM g a JOIN g b ON a.t = b.f WHERE a.r <> 's'
  UNION ALL SELECT a.f, c.t, 'III', 3 FROM g a JOIN g b ON a.t = b.f JOIN g c ON b.t = c.f WHERE a.r <> 's'),
steps AS (
  SELECT f, t, 'D' AS m, ins || 'D' AS audit, 3 * n + 4 AS cost, NULL AS needs FROM x
  UNION ALL SELECT x.f, g.t, 'K', ins || 'K', 3 * n, g.r FROM x JOIN g ON x.t = g.f
  UNION ALL SELECT x.f, g.t, 'R', ins || 'R', 3 * n + 3, NULL FROM x JOIN g ON x.t = g.f WHERE g.r <> 's'),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 'E' AS s, 0 AS cost, '' AS audit FROM e
  UNION ALL
  SELECT conv_id, i, s, way.cost, way.audit FROM (
    SELECT dp.conv_id, e.i, steps.t AS s, min(struct_pack(cost := dp.cost + steps.cost + CASE WHEN e.fault = 't' AND steps.m <> 'D' THEN 3 ELSE 0 END,
                                                          audit := dp.audit || steps.audit)) AS way
    FROM dp JOIN e ON e.conv_id IS NOT DISTINCT FROM dp.conv_id AND e.i = dp.i + 1 JOIN steps ON steps.f = dp.s
    WHERE (steps.m = 'D' OR e.fault NOT IN ('b', 'd')) AND (steps.needs IS NULL OR steps.needs = e.r)
    GROUP BY 1, 2, 3)),
z AS (
  SELECT dp.conv_id, min(struct_pack(cost := dp.cost + 3 * x.n, audit := dp.audit || x.ins)) AS way
  FROM dp JOIN (SELECT conv_id, max(i) AS n FROM e GROUP BY 1) l ON l.conv_id IS NOT DISTINCT FROM dp.conv_id AND l.n = dp.i JOIN x ON x.f = dp.s
  WHERE x.t IN ('E', 'A') GROUP BY 1),
l AS (
  SELECT conv_id, k, substr(way.audit, k, 1) AS edit,
         sum(CASE WHEN substr(way.audit, k, 1) = 'I' THEN 0 ELSE 1 END) OVER w AS i,
         sum(CASE WHEN substr(way.audit, k, 1) = 'D' THEN 0 ELSE 1 END) OVER w - 1 AS made,
         length(replace(way.audit, 'D', '')) % 2 AS led
  FROM (SELECT *, unnest(range(1, length(way.audit) + 1)) AS k FROM z) WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
q AS (
  SELECT l.conv_id, sha256(string_agg(
    CASE WHEN edit = 'K' THEN e.role WHEN (made - led) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE e.text END, chr(10) ORDER BY k)) AS h
  FROM l LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM l.conv_id AND e.i = l.i WHERE edit <> 'D' GROUP BY 1),
f AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (i > 1 AND p || r NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY 1)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       CAST(coalesce(z.way.cost, 0) AS BIGINT) AS cost, coalesce(z.way.audit, '') AS audit, coalesce(q.h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM a.conv_id""")
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repaired_digests(table(spark, folder, "conversations"))


def repaired_digests(rows: DataFrame) -> DataFrame:
    """The report of every conversation after damage and repair, with a digest of its repaired lines."""
    report, lines = repair(damaged(rows))
    line = F.concat("role", F.lit(":"), "text").alias("line")
    ordered = lines.select("conv_id", "place", "at", line).repartition("conv_id").sortWithinPartitions("conv_id", "place", "at").select("conv_id", "line")
    digests = ordered.mapInArrow(_digested, f"conv_id {lines.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")
    every = rows.select("conv_id").distinct()
    out = every
    for part in (report, digests):
        named = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(named, out["conv_id"].eqNullSafe(named["_conv"]), "left").drop("_conv")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    filled = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in numbers]
    return out.select("conv_id", *filled, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
