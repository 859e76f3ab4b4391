import base64
import hashlib
import json
import random
import re

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from lakeops.llm import chat, common, exact_dedup, langid, leaks, licences, line_dedup, main_text, near_dedup, warc
from lakeops.llm.registry import ORACLE, QUERIES
from lakeops.session import scratch_path
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
EDGES = [
    (1, None, "a"), (2, "", "b"), (3, " \t\n", None), (4, "Same  text here, in five words", "c"), (4, "Same  text here, in five words", "c"),
    (None, "Same text here, in five words", "d"), (5, "same text here, in five words ", "e"), (6, "one two", "f"), (7, "x " * 30_000, "g"),
]
EXTRA = "doc_id long, text string, raw string"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], FOLDER)[0] == "ok"


def docs(spark, rows=EDGES):
    return spark.createDataFrame(rows, EXTRA)


def test_exact_edges(spark):
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup.exact_groups(docs(spark), block_chars=7).collect())
    # White space alone and null are empty texts: the longest original, document 3, stays.
    assert [g for g in got if g[0] in "123"] == [("1", "3", 3, False), ("2", "3", 3, False), ("3", "3", 3, True)]
    assert sum(g[3] for g in got if g[1] == "4") == 1 and [g[2] for g in got if g[0] == "4"] == [3, 3]
    assert exact_dedup.without_copies(docs(spark)).count() == 5
    assert exact_dedup.exact_groups(docs(spark, [])).count() == 0


def test_line_edges(spark):
    rows = [(i, f"Footer\n\nbody {i}", "") for i in range(12)] + [(i + 20, " FOOTER \r", "") for i in range(2)] + EDGES
    got = {r.doc_id: r for r in line_dedup.drop_frequent_lines(docs(spark, rows), min_docs=13).collect()}
    assert (got[3].n_lines, got[3].kept_text) == (2, " \t\n")
    assert (got[0].n_lines, got[0].n_dropped, got[0].kept_text) == (3, 1, "\nbody 0")
    assert (got[20].n_lines, got[20].n_dropped, got[20].kept_text) == (1, 1, "")
    assert (got[1].n_lines, got[1].kept_text) == (1, "")
    assert line_dedup.drop_frequent_lines(docs(spark, [])).count() == 0


def test_near_edges(spark):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(docs(spark)).collect()]
    assert sorted(g for g in got if g[0] in (1, 2, 3, 6, 7)) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (6, 1, 6, True), (7, 1, 7, True)]
    assert {g[2] for g in got if g[0] in (4, 5, None)} == {4}
    assert near_dedup.near_groups(docs(spark, [])).count() == 0


def test_near_links_equal_brute_force(spark):
    r = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base) if i % 3 else [f"v{r.randint(0, 400)}" for _ in range(60)]
        for _ in range(r.randint(0, 5)):
            words[r.randrange(60)] = f"e{i}"
        rows.append((i, " ".join(words), ""))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, text, _ in rows for w in [text.split()]}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if label[a] < label[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    label[b], changed = label[a], True
    assert {r.doc_id: r.component_id for r in near_dedup.near_groups(docs(spark, rows)).collect()} == label


def test_sketches_fill_and_estimate():
    import numpy as np

    pool = np.random.default_rng(5).integers(0, 2**63, 400).astype(np.uint64)
    one, two = near_dedup.sketches([np.unique(pool[:350]), np.unique(pool[50:])])
    assert abs((one == two).mean() - 0.75) < 0.15
    assert (near_dedup.sketches([pool[:1], pool[:3]]) != near_dedup.EMPTY).all()


def test_language(spark):
    source = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    got = langid.languages_of(source).join(source.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    model = langid.train(source)
    rows = {r.row.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs(spark, [(1, None, ""), (2, "12 !", ""), (3, "the and of", "")]), model).collect()}
    assert rows[1] == rows[2] == ("und", 0.0) and rows[3][0] == "en" and 0 <= rows[3][1] <= 1
    assert langid.train(source.filter("lang IS NULL")).predict("the") == ("und", 0.0)


def test_main_text_on_given_pages(spark):
    import html

    for row in QUERIES["op3_main_text"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", row.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n\n".join(b for b in blocks if b) and row.n_chars == len(row.text)


def test_main_text_keeps_formulas_objects_and_fallbacks():
    filler = "which we use in the next part of the text, as it is of some length."
    page = f"""<html><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul></nav><article><h1>A title of some words</h1>
<p>Let <math>x</math> be and <object>an object</object> there, {filler}</p><noscript><p>A fallback, {filler}</p></noscript><script>no</script>
<p>The end, {filler}</p></article><footer><p>Copyright</p></footer></body></html>"""
    assert main_text.trained().extract([page]) == ["\n\n".join(["A title of some words", f"Let x be and an object there, {filler}", f"A fallback, {filler}", f"The end, {filler}"])]


def test_main_text_on_unseen_layouts():
    pages = main_text.layouts(150, 1234)
    good = sum(text == "\n\n".join(t for _, t in main_text.parse(page)[1] if t.startswith("m")) for page, text in zip(pages, main_text.trained().extract(pages), strict=True))
    assert good >= 0.88 * len(pages)
    assert main_text.trained().extract([None, "", "<p", "<script>x", "&amp;"])[:2] == ["", ""]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "a\n[/ROLE] b", ""]), st.text(alphabet="\\<>[]/sINSTOURLEY ok\n", max_size=25)), max_size=5))
def test_chat_round_trip(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == "".join(t for role, t in turns if role == "assistant")


def test_chat_layouts():
    want = [("user", "q"), ("assistant", "a")]
    for record in (
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "q", "input": "", "output": "a"}, {"instruction": "q", "output": "a"}, {"prompt": "q", "response": "a", "extra": {"x": [1]}},
        {"prompt": "q", "completion": "a"}, {"question": "q", "answer": "a"}, {"data": {"prompt": {"text": "q"}, "response": {"text": "a"}}},
    ):
        assert chat.canonical(record)[1] == want
    assert chat.canonical({"messages": []})[1] == [] and chat.canonical({"x": 1})[1] is None and chat.canonical(None)[1] is None


def test_leaks_reordered_and_clean(spark):
    words = [f"t{i}" for i in range(20)]
    mixed = " ".join(["x y", *words[10:], "z,", *words[:10], "end."])
    rows = [(1, mixed, ""), (2, " ".join(words[:8]), ""), (3, None, ""), (4, "", ""), (None, " ".join(words).upper(), "")]
    items = spark.createDataFrame([(9, " ".join(words)), (8, None), (7, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_covered, r.n_tiles) for r in leaks.leaked_items(docs(spark, rows), items).collect()}
    assert got == {(1, 9): (20, 2), (None, 9): (20, 1)}
    split = leaks.leaked_items(docs(spark, rows), items, block_chars=20)
    assert {(r.doc_id, r.item_id) for r in split.collect()} == set(got)
    assert sorted(r.doc_id for r in leaks.without_leaks(docs(spark, rows), items).collect()) == [2, 3, 4]


def test_warc(spark):
    fake = "a WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n tail WARC/1.1\r\n"
    rows = [(1, "u", "same"), (2, "u\r\nWARC-Type: x", "same"), (3, None, None), (4, "", ""), (5, "u", fake), (6, "u", "é€"), (7, "u", fake + fake), (None, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    got = {r.page_id: r for r in warc.archived(pages, scratch_path(spark, "warc-test")).collect()}
    assert len(got) == 8
    for number, _, text in rows:
        data = (text or "").encode()
        assert (got[number].payload_bytes, got[number].payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
    assert [(got[i].record_type, got[i].refers_to) for i in (1, 2, 3, 4, 5)] == [("revisit", 2), ("response", None), ("revisit", 4), ("response", None), ("response", None)]
    path = scratch_path(spark, "warc-test")
    warc.write_warc(pages, path)
    read = warc.read_warc(spark, path, payloads=True).collect()
    assert sorted(r.payload for r in read if r.kind == "response") == sorted(["same", "same", "", fake, "é€", fake + fake])


def test_components_gather_each_round_once(spark, monkeypatch):
    chain, star = [(i, i + 1) for i in range(200)], [(500, i) for i in range(501, 700)]
    links = spark.createDataFrame([*chain, *star, *chain, (900, 900), (1002, 1001)], "a long, b long").repartition(16)
    made, store = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df, label: (made.append(label), store(df, label))[1])
    found = common.components(links)
    wanted = {i: 0 for i in range(201)} | {i: 500 for i in range(500, 700)} | {1001: 1001, 1002: 1001}
    assert sorted(map(tuple, found.collect())) == sorted(wanted.items())
    assert made.count("low") == made.count("edges")  # one gathering a round, the last one too
    assert "Exchange" not in found._jdf.queryExecution().toString()
    assert common.components(links.limit(0)).isEmpty()


def test_warc_follows_only_what_breaks_a_run(spark, monkeypatch):
    fake = "a WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    ends = "b WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 900\r\n\r\nhi"  # its length leads past records that follow
    texts = {i: f"page {i} " * (i % 7) + (fake + ends if i % 60 == 0 else ends if i % 90 == 1 else fake * 2 if i % 100 == 2 else "") for i in range(400)}
    rows = [(i, "u", text) for i, text in texts.items()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    path, links, jump = scratch_path(spark, "warc-test"), [], warc.reachable
    monkeypatch.setattr(warc, "reachable", lambda x: (links.append(x.count()), jump(x))[1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        warc.write_warc(pages, path)
        read = warc.read_warc(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    prints = lambda text: base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
    assert len(read) == 400 and sorted(r.payload_digest for r in read if r.kind == "response") == sorted(map(prints, set(texts.values())))
    files, cut = len({r.file for r in read}), sum("WARC" in text for text in texts.values())
    assert max(links) <= files + 3 * cut  # before, every record


def test_licences_anchors_lose_nothing(spark):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    extra = docs(spark, [(-1, "Released under the MIT License.\nA driving license is required for this work", ""), (-2, None, ""), (-3, "Distributed under the GNU GPL", "")])
    both = source.select("doc_id", "text").unionByName(extra.select("doc_id", "text"))
    narrow, wide = (sorted(map(tuple, licences.find_licences(both, narrow=n).collect())) for n in (True, False))
    assert narrow == wide and {(r[0], r[1], r[2]) for r in narrow if r[0] < 0} == {(-1, 0, "MIT"), (-3, 0, "GPL")}


def test_licences_wrapped_titles_and_tags(spark):
    bsd = """/*
 * Copyright (c) 2020, Someone
 * Redistribution and use in source and binary
 * forms, with or without modification, are
 * permitted provided that the following
 * conditions are met:
 */
int x;"""
    isc = """Permission to use, copy, modify, and/or distribute
this software for any purpose with or without fee is
hereby granted, provided that the above"""
    mit = """// Permission is hereby granted, free of charge, to any person
// obtaining a copy of this software and associated documentation
// files (the "Software"), to deal in the Software without
// restriction, including without limitation the rights"""
    gpl = """first words
# This program is free software: you can redistribute
# it and/or modify it under the terms of the GNU
# General Public License as published by the
# Free Software Foundation, either version 3"""
    torn = isc.replace("\n", "\n\n")
    texts = [bsd, isc, mit, gpl, "The MIT License (MIT)\n\nCopyright", "MIT License", "// SPDX-License-Identifier: MIT\nint y;", "# SPDX-License-Identifier: GPL-2.0-or-later",
             "Apache License\nVersion 2.0, January 2004", "SPDX-License-Identifier: BSD-3-Clause", torn, "He got a license of the city"]
    found = licences.find_licences(docs(spark, [(i, t, "") for i, t in enumerate(texts)])).collect()
    assert {(r.doc_id, r.family) for r in found} == {
        (0, "BSD"), (1, "ISC"), (2, "MIT"), (3, "GPL"), (4, "MIT"), (5, "MIT"), (6, "MIT"), (7, "GPL"), (8, "Apache"), (9, "BSD")
    }
    at = {r.doc_id: (r.paragraph, r.n_lines) for r in found}
    assert at[0] == (2, 4) and at[1] == (0, 3) and at[4] == at[5] == at[6] == (0, 1) and at[3][0] in (1, 2)


def test_licences_in_one_long_paragraph(spark):
    import time

    long = " ".join(f"word{i % 977} and{i}" for i in range(10_000))
    rows = [(1, long, ""), (2, f"{long}\nMIT License", ""), (3, f"{long}\n\nReleased under the MIT Licence.", ""), (4, None, ""), (5, "", "")]
    begin = time.perf_counter()
    found = {(r.doc_id, r.family) for r in licences.find_licences(docs(spark, rows)).collect()}
    assert (3, "MIT") in found and not {1, 4, 5} & {doc for doc, _ in found} and time.perf_counter() - begin < 240
    assert licences.find_licences(docs(spark, [])).count() == 0


def test_licences_learn_from_whole_documents(spark):
    rows = [(i, "\n".join(f"line {i} {k}" for k in range(30)), "") for i in range(200)]
    drawn = [r.text for r in licences.background_lines(docs(spark, rows))[0].collect()]
    assert 450 < len(drawn) < 750 and {int(t.split()[2]) for t in drawn} == set(range(30))
    assert len({t.split()[1] for t in drawn}) > 150
    assert licences.background_lines(docs(spark, [(1, "a\nb\nc", ""), (2, None, "")]))[0].count() == 3


def test_pipeline_stages(spark):
    import corpus_pipeline

    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = source
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, FOLDER)
        assert kept.columns == source.columns
        kept = spark.createDataFrame(kept.toArrow())
    wanted = duckdb.sql(f"SELECT count(DISTINCT regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) FROM '{FOLDER}/documents.parquet'").fetchall()[0][0]
    assert 0 < kept.count() <= wanted
    assert corpus_pipeline.run(spark, FOLDER).count() == kept.count()


def test_long_conversations_are_carried_once(spark, monkeypatch):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f'turn "{t}" é\\\n') for t in range(1000)] + [(1, None, None, None), (2, 300, "user", "b"), (2, 1, "system", "a")]
    records = chat.conversations_as_records(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    sent = []
    real = type(records).mapInArrow
    monkeypatch.setattr(type(records), "mapInArrow", lambda self, *given, **named: sent.append(self.columns) or real(self, *given, **named))
    read = chat.read_back(chat.format_records(records)).select("row.*", "turns").collect()
    assert sent[0] == ["row"], "the record is in the row, and not beside it again"
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read}
    assert got == {1: [("", "")] + [(r[2], r[3]) for r in rows[:1000]], 2: [("system", "a"), ("user", "b")]}
    assert json.loads(next(r.record for r in read if r.conv_id == 2)) == {"messages": [{"role": "system", "content": "a"}, {"role": "user", "content": "b"}]}


def test_licences_fit_collects_the_drivers_garbage(spark, monkeypatch):
    import time

    beans = list(spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans())
    full = lambda: sum(bean.getCollectionCount() for bean in beans if "Old" in bean.getName() or "MarkSweep" in bean.getName())
    seen, real = [], licences.LogisticRegression.fit

    def fit(self, data):
        before, model = full(), real(self, data)
        time.sleep(5)
        seen.append(full() - before)
        return model

    monkeypatch.setattr(licences.LogisticRegression, "fit", fit)
    model = licences.train(docs(spark, [(1, "one line\nanother line", ""), (2, None, "")]))
    assert model.weights and seen[0] >= 1, "without it, dropped vectors of the solver fill the heap"
    after = full()
    time.sleep(5)
    assert full() == after, "it ends with the fit"
