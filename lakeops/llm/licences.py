"""Licence statements in documents, by a trained classifier of passages. DataFrame operations only.

A passage is a line, or some lines in a row of one paragraph (lines with words, up to a line without)
that together hold a template, as notices wrapped by hand do. Comment marks hold no word, so they
neither count nor join paragraphs.

A sparse logistic regression over word 1- and 2-grams gives each passage a licence family or
``unknown``; its probabilities are tempered on held-out rows, and below a threshold the answer is
``unknown`` too. A predicted family stands only if a template of it is found in the passage: enough
of the word 3-grams of a sentence, a bare title as the whole passage, or an SPDX tag.

That confirmation also says which passages can't come out as a licence. ``anchors`` picks words
such that no template can be confirmed without one of them, and passages without any aren't looked
at further. Equal passages are classified once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeops.llm.common import collected, query, stored, table
from lakeops.session import local_table

# Names of licences, and sentences of their notices.
NAMES = {
    "MIT": ["MIT License", "MIT license", "Expat License"],
    "Apache": ["Apache License", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license"],
    "BSD": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "New BSD License", "Simplified BSD License"],
    "GPL": ["GNU General Public License", "GNU General Public License, version 2", "GNU General Public License, version 3", "GNU GPL", "GPL v2", "GPL v3", "GPLv3"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License, version 3", "GNU LGPL", "LGPL v3"],
    "AGPL": ["GNU Affero General Public License", "GNU Affero General Public License, version 3", "GNU AGPL", "AGPL v3"],
    "MPL": ["Mozilla Public License", "Mozilla Public License, version 2.0", "MPL 2.0"],
    "ISC": ["ISC License"],
    "EPL": ["Eclipse Public License", "Eclipse Public License 2.0"],
    "CC-BY": ["Creative Commons Attribution License", "Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC BY 3.0"],
    "CC-BY-SA": ["Creative Commons Attribution-ShareAlike License", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC BY-SA 3.0"],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial License", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC BY-NC 3.0"],
    "CC-BY-ND": ["Creative Commons Attribution-NoDerivatives License", "CC BY-ND 4.0"],
    "CC0": ["CC0 1.0", "CC0 1.0 Universal Public Domain Dedication"],
}
FRAMES = ["Licensed under the {}", "Licensed under {}", "Released under the {}", "Released under {}", "This work is licensed under the {}", "This work is licensed under {}",
          "Distributed under the {}", "Distributed under {}", "Available under the terms of the {}", "This project is licensed under the {}"]
NOTICES = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "Apache": ["you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"],
    "GPL": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "LGPL": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License"],
}
#: What a passage that is a title and nothing more says; {1} is the family.
TITLES = ["{0}", "The {0}", "{0} ({1})", "The {0} ({1})", "License: {0}"]
TAG = "spdx-license-identifier"
#: Identifiers of SPDX tags.
TAGS = {
    "MIT": ["MIT", "MIT-0"],
    "Apache": ["Apache-2.0", "Apache-1.1"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "0BSD"],
    "GPL": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL": ["LGPL-2.0", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "MPL": ["MPL-1.1", "MPL-2.0"],
    "ISC": ["ISC"],
    "EPL": ["EPL-1.0", "EPL-2.0"],
    "CC-BY": ["CC-BY-3.0", "CC-BY-4.0"],
    "CC-BY-SA": ["CC-BY-SA-3.0", "CC-BY-SA-4.0"],
    "CC-BY-NC": ["CC-BY-NC-3.0", "CC-BY-NC-4.0"],
    "CC-BY-ND": ["CC-BY-ND-3.0", "CC-BY-ND-4.0"],
    "CC0": ["CC0-1.0"],
}
#: Sentences that speak of licences and state none.
OTHERS = ["A driving license is required for this work", "The license plate was found under the car", "Permission to enter was granted by the public office",
          "The general public was released under the terms of the new version", "All rights reserved by the author", "Please read the terms of use",
          "The software is available free of charge in all versions", "He was licensed to distribute the source"]
UNKNOWN = "unknown"


def templates() -> list[tuple[str, str]]:
    stated = [(family, frame.format(name)) for family, names in NAMES.items() for frame, name in product(FRAMES, names)]
    return stated + [(family, text) for family, texts in NOTICES.items() for text in texts]


def named() -> list[tuple[str, str]]:
    """Names and identifiers that make titles; those of a few letters are words of other meaning too."""
    return [(family, name) for names in (NAMES, TAGS) for family, listed in names.items() for name in listed if len(name) > 4]


def titles() -> list[tuple[str, str]]:
    """Titles that state a licence where they stand alone."""
    return list(dict.fromkeys((family, title.format(name, family)) for family, name in named() for title in TITLES))


def tags() -> list[tuple[str, str]]:
    return [(family, f"SPDX-License-Identifier: {name}") for family, names in TAGS.items() for name in names]


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and inner dots and hyphens; a licence is spelt license."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), "licen([cs])e", "license"), F.lit(r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"), F.lit(0))


def runs(column: Column, n: int) -> Column:
    """Runs of n words; all words as one run where there are fewer."""
    last = F.greatest(F.size(column) - (n - 1), F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(column, i, n), " "))


def whole(column: Column) -> Column:
    """All words as what a title is compared with."""
    return F.concat(F.lit("= "), F.array_join(column, " "))


def marks(column: Column) -> Column:
    """What templates are compared with: runs of 3 words, the whole, and SPDX tags with the word after them."""
    tagged = F.filter(runs(column, 2), lambda run: run.startswith(f"{TAG} "))
    return F.array_distinct(F.concat(runs(column, 3), F.array(whole(column)), tagged))


def grams(column: Column) -> Column:
    return F.array_distinct(F.concat(column, F.when(F.size(column) > 1, runs(column, 2)).otherwise(F.array())))


def anchors(texts: list[list[str]], share: float) -> list[str]:
    """Words without any of which less than ``share`` of every text's 3-word runs can occur: greedily the one in most open texts."""
    shingles = [{tuple(t[i : i + 3]) for i in range(max(1, len(t) - 2))} for t in texts]
    chosen: list[str] = []
    while True:
        free = [{s for s in ss if not any(w in chosen for w in s)} for ss in shingles]
        open_ = [f for f, ss in zip(free, shingles, strict=True) if len(f) >= share * len(ss)]
        if not open_:
            return chosen
        weight: dict[str, float] = {}
        for f in open_:
            for s in f:
                for w in set(s):
                    weight[w] = weight.get(w, 0) + len(w) ** 2 / len(f)
        chosen.append(max(sorted(weight), key=lambda w: weight[w]))


@dataclass
class Model:
    """Weights of n-grams by family, and the temperature of the probabilities."""

    families: list[str]
    start: list[float]
    weights: list[tuple[str, list[float]]]
    temperature: float


def background_lines(docs: DataFrame, text: str = "text", most: int = 2_000, per_document: int = 3) -> tuple[DataFrame, DataFrame]:
    """Lines (place, text) of about ``per_document`` lines of each of about ``most`` documents, both drawn by hash, wherever
    in the document they stand (all lines of a document with fewer), and the paragraphs (place, words) they stand in."""
    total = docs.count() or 1
    below = lambda bound, *key: F.pmod(F.xxhash64(*key), F.lit(2**32)) < bound
    picked = docs.filter(below(int(min(1.0, most / total) * 2**32), F.col(text), F.lit("licences")) & F.col(text).isNotNull())
    split = lambda column: F.split(column, "\n", -1)
    # Cut where a line without words stands.
    parts = F.posexplode(F.split(text, r"\n[^\p{L}\p{N}\n]*(?=\n)", -1)).alias("part", "paragraph")
    paragraphs = picked.select(F.xxhash64(text).alias("of"), F.size(split(text)).alias("n"), parts).withColumn("place", F.monotonically_increasing_id())
    # Stored, so that a paragraph has one number and is cut into words once.
    paragraphs = stored(paragraphs.withColumn("words", words(F.col("paragraph"))), "paragraphs")
    lines = paragraphs.select("of", "n", "part", "place", F.posexplode(split(F.col("paragraph"))).alias("at", "text"))
    lines = lines.filter(below(F.least(F.lit(1.0), per_document / F.col("n")) * 2**32, "of", "part", "at", "text")).select("place", "text")
    return lines, paragraphs.select("place", "words")


def train(docs: DataFrame, text: str = "text", background: int = 2_000) -> Model:
    """A model from the templates, with endings and openings varied, against ``unknown``: sentences that
    state no licence, and lines of the documents (``background_lines``) whose paragraph shares no 3-word
    run with a template: the rest of a notice says as little against it as the templates themselves."""
    spark = docs.sparkSession
    stated = [*templates(), *titles(), *tags() * 2]
    positive = list(stated)
    positive += [(f, " ".join(t.split()[k:])) for f, t in templates() for k in (1, 2) if len(t.split()) > 5]
    # Each template is learned from; only endings, openings and background are left out below.
    rows = local_table(spark, [*((f, t, k < len(stated)) for k, (f, t) in enumerate(positive)), *[(UNKNOWN, t, False) for t in OTHERS * 5]], "label string, text string, learned boolean")
    known = local_table(spark, [*templates(), *titles(), *tags()], "label string, text string").withColumn("words", words(F.col("text")))
    known = stored(known, "known").select(F.explode(runs(F.col("words"), 3)).alias("run")).distinct()
    line, paragraph = background_lines(docs, text, background)
    line = line.filter(F.size(words(F.col("text"))) > 0).distinct()
    drawn = paragraph.join(line.select("place").distinct(), "place", "left_semi").select("place", F.explode(runs(F.col("words"), 3)).alias("run"))
    stating = drawn.join(known, "run").select("place").distinct()
    line = line.join(stating, "place", "left_anti").select(F.lit(UNKNOWN).alias("label"), "text", F.lit(False).alias("learned")).distinct()
    rows = stored(rows.unionAll(line).withColumn("words", words(F.col("text"))), "licence-lines")
    rows = stored(rows.withColumn("grams", grams(F.col("words"))).drop("words"), "licence-rows")
    families = sorted({UNKNOWN, *NAMES})
    place = F.create_map(*[F.lit(x) for i, f in enumerate(families) for x in (f, float(i))])
    numbered = rows.withColumn("y", place[F.col("label")]).withColumn("fold", F.when(F.col("learned"), 1).otherwise(F.pmod(F.xxhash64("text"), F.lit(5))))
    counted = CountVectorizer(inputCol="grams", outputCol="x", vocabSize=20_000, minDF=2.0, binary=True).fit(numbered)
    fitted = LogisticRegression(featuresCol="x", labelCol="y", maxIter=40, regParam=1e-3, elasticNetParam=0.3, family="multinomial")
    with collected(spark):
        rest = fitted.fit(counted.transform(numbered.filter("fold > 0")))
    # Temperature with the best likelihood on the fifth of the rows left out.
    left = rest.transform(counted.transform(numbered.filter("fold = 0"))).select("rawPrediction", "y").collect()
    odds, y = np.array([r.rawPrediction.toArray() for r in left]), np.array([int(r.y) for r in left], int)

    def loss(t: float) -> float:
        z = odds / t
        top = z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z - top).sum(axis=1)) + top[:, 0] - z[np.arange(len(y)), y]).mean())

    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss) if len(y) else 1.0
    matrix = rest.coefficientMatrix.toArray()
    weights = [(gram, [float(v) for v in matrix[:, j]]) for j, gram in enumerate(counted.vocabulary) if matrix[:, j].any()]
    return Model(families, [float(v) for v in rest.interceptVector.toArray()], weights, temperature)


def classify(paragraphs: DataFrame, model: Model, min_probability: float = 0.5) -> DataFrame:
    """paragraphs (text, words) with family and probability; the n-gram weights are a table of bounded size."""
    spark, k = paragraphs.sparkSession, len(model.families)
    weights = local_table(spark, model.weights, "gram string, w array<double>")
    exploded = paragraphs.select("text", F.explode(grams(F.col("words"))).alias("gram")).join(F.broadcast(weights), "gram", "left")
    sums = exploded.groupBy("text").agg(*[F.sum(F.coalesce(F.col("w")[i], F.lit(0.0))).alias(f"s{i}") for i in range(k)])
    odds = F.array(*[(F.col(f"s{i}") + model.start[i]) / model.temperature for i in range(k)])
    scored = sums.select("text", odds.alias("odds")).withColumn("top", F.array_max("odds"))
    share = 1 / F.aggregate("odds", F.lit(0.0), lambda total, o: total + F.exp(o - F.col("top")))
    best = F.element_at(F.array(*map(F.lit, model.families)), F.array_position("odds", F.col("top")).cast("int"))
    sure = scored.select("text", best.alias("family"), share.alias("probability"))
    return sure.withColumn("family", F.when(F.col("probability") >= min_probability, F.col("family")).otherwise(UNKNOWN))


def spans(lines: DataFrame, known: DataFrame, min_share: float) -> DataFrame:
    """(row, line, last, text) of lines in a row, inside a paragraph, that hold ``min_share`` of a sentence's
    3-word runs within twice its length.

    ``lines``: (row, line, text, words) of lines with words; ``known``: (template, runs) of sentences.
    """
    here = F.col("line") - F.row_number().over(Window.partitionBy("row").orderBy("line"))
    lined = lines.withColumn("part", here)
    listed = F.array_sort(F.collect_list(F.struct("line", "words")))
    parts = lined.groupBy("row", "part").agg(listed.alias("lines")).filter(F.size("lines") > 1)
    placed = F.flatten(F.transform("lines", lambda x: F.transform(x["words"], lambda w: F.struct(x["line"].alias("line"), w.alias("word")))))
    parts = parts.select("row", "part", placed.alias("at")).filter(F.size("at") > 2)
    run = lambda i: F.struct(
        F.array_join(F.transform(F.slice("at", i, 3), lambda x: x["word"]), " ").alias("run"), i.alias("place"),
        F.element_at("at", i)["line"].alias("line"), F.element_at("at", i + 2)["line"].alias("last"),
    )
    ran = parts.select("row", "part", F.inline(F.transform(F.sequence(F.lit(1), F.size("at") - 2), run)))
    held = ran.join(F.broadcast(known.select("template", F.size("runs").alias("size"), F.explode("runs").alias("run"))), "run")
    after = Window.partitionBy("row", "part", "template").orderBy(F.floor(F.col("place") * 1000 / F.col("size"))).rangeBetween(0, 2000)
    found = held.withColumns({"share": F.size(F.collect_set("run").over(after)) / F.col("size"), "end": F.max("last").over(after)})
    found = found.filter((F.col("share") >= min_share) & (F.col("end") > F.col("line"))).select("row", "line", F.col("end").alias("last")).distinct()
    inside = lines.select("row", F.col("line").alias("n"), F.col("text").alias("t"))
    joined = found.join(inside, "row").filter(F.col("n").between(F.col("line"), F.col("last"))).groupBy("row", "line", "last")
    ordered = F.array_sort(F.collect_list(F.struct("n", "t")))
    return joined.agg(F.array_join(F.transform(ordered, lambda x: x["t"]), " ").alias("text"))


def find_licences(
    docs: DataFrame, text: str = "text", key: str = "doc_id", min_share: float = 0.6, min_probability: float = 0.5, narrow: bool = True
) -> DataFrame:
    """(doc_id, paragraph, family, probability, template_share, n_lines) of the passages that state a licence.

    ``paragraph`` is the number of a passage's first line, from 0, and ``n_lines`` how many lines it has. Of
    passages of one family that share a line, the one with the highest share stands, then the shortest,
    then the first. Null and empty texts have none; rows that repeat a key give rows of their own; other
    columns are ignored. ``narrow`` uses the anchors.
    """
    spark = docs.sparkSession
    model = train(docs, text)
    stated = local_table(spark, templates(), "family string, template string").withColumn("runs", F.array_distinct(runs(words(F.col("template")), 3)))
    alone = local_table(spark, titles(), "family string, template string").withColumn("runs", F.array(whole(words(F.col("template")))))
    tagged = local_table(spark, tags(), "family string, template string").withColumn("runs", F.array(F.array_join(words(F.col("template")), " ")))
    # Stored, so that the words of a template are cut once.
    known = stored(stated.unionAll(alone).unionAll(tagged), "templates")
    stated = stored(stated, "sentences")
    held = lambda column: F.lit(True)
    if narrow:
        listed = local_table(spark, [*((True, t) for _, t in templates()), *((False, t) for _, t in named())], "sentence boolean, text string")
        listed = [(r.sentence, list(r.w)) for r in listed.select("sentence", words(F.col("text")).alias("w")).collect()]
        # A title or tag stands only with every word of its name, so one word of each is enough.
        chosen = {*anchors([w for sentence, w in listed if sentence], min_share), *(max(w, key=len) for sentence, w in listed if not sentence), TAG}
        needed = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"\\Q{w}\\E" for w in sorted(chosen)) + r")(?![\p{L}\p{N}])"
        held = lambda column: F.lower(column).rlike(needed)
    given = docs.filter(F.col(text).isNotNull() & held(F.col(text))).select(F.struct(F.monotonically_increasing_id().alias("at"), F.col(key).alias("doc_id")).alias("row"), F.col(text).alias("text"))
    lines = given.select("row", F.posexplode(F.split("text", "\n", -1)).alias("line", "text")).withColumn("words", words(F.col("text")))
    # Stored, so that a row has one number in all that follows.
    lines = stored(lines.filter(F.size("words") > 0), "lines")
    wrapped = spans(lines, stated, min_share)
    passages = lines.filter(held(F.col("text"))).select("row", "line", F.col("line").alias("last"), "text").unionAll(wrapped)
    passages = stored(passages, "passages")
    distinct = passages.select("text").distinct().withColumn("words", words(F.col("text")))
    distinct = stored(distinct, "distinct")
    said = classify(distinct, model, min_probability).filter(F.col("family") != UNKNOWN)
    own = said.join(distinct, "text").select("text", "family", "probability", marks(F.col("words")).alias("own"))
    best = F.max(F.size(F.array_intersect("own", "runs")) / F.size("runs")).alias("template_share")
    confirmed = own.join(F.broadcast(known), "family").groupBy("text", "family", "probability").agg(best).filter(F.col("template_share") >= min_share)
    # Stored, so that the passages of one frequent text can be split in the join.
    confirmed = stored(confirmed, "confirmed")
    n_lines = F.col("last") - F.col("line") + 1
    rated = F.struct((-F.col("template_share")).alias("worse"), n_lines.alias("n_lines"), "line", "last", "probability")
    sorted_ = passages.join(confirmed, "text").groupBy("row", "family").agg(F.array_sort(F.collect_list(rated)).alias("rated"))
    shared = lambda kept, x: F.exists(kept, lambda k: (k["line"] <= x["last"]) & (k["last"] >= x["line"]))
    none = F.filter("rated", lambda x: F.lit(False))
    kept = F.aggregate("rated", none, lambda kept, x: F.when(shared(kept, x), kept).otherwise(F.concat(kept, F.array(x))))
    return sorted_.select("row", "family", F.inline(kept)).select(
        "row.doc_id", F.col("line").cast("long").alias("paragraph"), "family", F.round("probability", 6).alias("probability"),
        (-F.col("worse")).alias("template_share"), F.col("n_lines").cast("long").alias("n_lines"),
    )


@query("op2_licences")
def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    return find_licences(table(spark, folder, "documents"))
