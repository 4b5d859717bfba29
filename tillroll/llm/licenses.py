"""License scans: a trained paragraph classifier, all in DataFrame operations.

Paragraphs: every line of the text, and every window of consecutive lines over which a notice may be wrapped: its
first and last line hold a known word, no line is without words, and the lines between hold no more words
than the longest notice, as they would lie inside it.  A window keeps as many words of its outer lines at most.

Features: the distinct words, word pairs and word triples of a paragraph (a line of the text) that the notices
of the licence families hold, without those that are common in other paragraphs or hold common words only.

Training: multinomial logistic regression (spark.ml) on the family notices, on parts of them, and on every
distinct line of the corpus that holds at most one word pair of any notice (class ``unknown``); the lines that
hold the same known n-grams are one row with their number as weight.

Prediction: weights are a table (n-gram, weight of each class); the known n-grams of all paragraphs are joined
with it, summed per paragraph and turned into class probabilities.  A paragraph without any known n-gram
scores the intercepts, which is ``unknown``, and needs no row.  Calibration: all distinct lines with a known word and at
most one known word pair of a notice give the probability, to a millionth, that all but ``false_rate`` of them stay
below; a family below that is ``unknown``.  Confirmation: the
largest share of a template's word pairs that the paragraph holds, over the family's templates, must
reach ``min_similarity``.  Of nested findings the tightest with the largest share stays: one that holds another
with at least its share goes, then one inside another with a larger share.

Null and empty texts have no paragraphs.  Repeated rows and lines are separate findings; ties between families
go to the smaller name.  A line of any length is one paragraph; a notice cut by a line without words is two.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import written

UNKNOWN = "unknown"

# Names and short public notices of licence families.
NOTICES = {
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.",
                 "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Released under the Apache 2.0 license."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0)."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU GPL v3.",
                "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "ISC": ["Licensed under the ISC license.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.",
                 "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages"],
}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def ngrams(name: str, most: int = 3) -> Column:
    """Distinct n-grams of 1 to ``most`` words of the word array in column ``name``."""
    each = [f"transform(sequence(0, size({name}) - {n}), i -> array_join(slice({name}, i + 1, {n}), ' '))" for n in range(1, most + 1)]
    kept = [f"if(size({name}) >= {n}, {e}, array())" for n, e in enumerate(each, 1)]
    return F.expr(f"array_distinct(concat({', '.join(kept)}))")


def bodies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lines): the lines of every text that is not null, in order."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.split(F.col(text_col).cast("string"), "\n").alias("lines")).where("lines is not null")


def windows(texts: DataFrame, single: list[str], longest: int) -> DataFrame:
    """(doc_id, row, paragraph, n_lines, w): the words of every line of ``bodies`` that holds a word of ``single``, and
    of every window of lines that a notice of at most ``longest`` words can be wrapped over; ``row`` tells repeated
    rows apart.  Per line only the next ``longest`` + 1 lines are carried, cut to ``longest`` + 1 words."""
    def known(line: Column) -> Column:
        return F.exists(line, lambda v: v.isin(single))

    rows = texts.select("doc_id", F.monotonically_increasing_id().alias("row"), F.transform("lines", words).alias("lw"))
    near = F.transform(F.col("lw"), lambda line, i: F.when(known(line), F.struct(
        i.alias("paragraph"), line.alias("first"),
        F.transform(F.slice(F.col("lw"), i + 2, longest + 1), lambda x: F.slice(x, 1, longest + 1)).alias("rest"))))
    rows = rows.select("doc_id", "row", F.explode(F.filter(near, lambda s: s.isNotNull())).alias("s")).select("doc_id", "row", "s.*")
    # how many of the next lines are reached: none is empty, and those before the last hold ``longest`` words at most
    reach = F.aggregate("rest", F.struct(F.lit(0).alias("k"), F.lit(0).alias("held"), F.lit(True).alias("on")), lambda a, x: F.when(
        a["on"] & (F.size(x) > 0) & (a["held"] <= longest),
        F.struct((a["k"] + 1).alias("k"), (a["held"] + F.size(x)).alias("held"), F.lit(True).alias("on"))).otherwise(
        F.struct(a["k"].alias("k"), a["held"].alias("held"), F.lit(False).alias("on"))))["k"]
    rest = F.slice("rest", F.lit(1), reach)
    tail = F.reverse(F.slice(F.reverse("first"), 1, longest))
    more = F.filter(F.transform(rest, lambda x, k: F.when(known(x), F.struct(
        (k + 2).alias("n_lines"), F.concat(tail, F.flatten(F.transform(F.slice(rest, F.lit(1), k + 1), lambda y: F.slice(y, 1, longest)))).alias("w")))), lambda s: s.isNotNull())
    one = F.array(F.struct(F.lit(1).alias("n_lines"), F.col("first").alias("w")))
    return rows.select("doc_id", "row", "paragraph", F.explode(F.concat(one, more)).alias("s")).select("doc_id", "row", "paragraph", "s.*")


def notices(spark: SparkSession, families: dict[str, list[str]]) -> DataFrame:
    """(family, template number, text)."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(i).alias("template"), F.lit(t).alias("text"))
            for f, texts in sorted(families.items()) for i, t in enumerate(texts)]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def line_grams(lines: DataFrame, grams: list[str]) -> DataFrame:
    """(g): for every distinct text of ``lines`` the sorted n-grams of ``grams`` that it holds, as a written table.  Texts
    are told apart by two 64-bit hashes, and only these and the n-grams found are dealt out."""
    single = sorted({w for x in grams for w in x.split(" ")})
    rows = lines.select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"), words(F.col("text")).alias("w"))
    # other words become null, and so does what holds one
    rows = rows.withColumn("w1", F.transform("w", lambda x: F.when(x.isin(single), x)))
    rows = rows.withColumn("w2", F.expr("zip_with(w1, slice(w1, 2, size(w1)), (x, y) -> concat(x, ' ', y))"))
    rows = rows.withColumn("w3", F.expr("zip_with(w2, slice(w1, 3, size(w1)), (x, y) -> concat(x, ' ', y))"))
    held = F.array_sort(F.array_distinct(F.filter(F.concat("w1", "w2", "w3"), lambda x: x.isin(grams))))
    return written(rows.select("h1", "h2", held.alias("g")).distinct().select("g"), "licence-lines")


def train(lines: DataFrame, families: dict[str, list[str]], common: float = 0.01, false_rate: float = 0.001) -> dict:
    """Weights (n-gram -> weight of each class), intercepts, class names, the calibrated threshold and ``learnt``, the
    number of paragraphs of class ``unknown``, from the notices and every distinct paragraph of ``lines``."""
    spark = lines.sparkSession
    known = notices(spark, families).withColumn("w", words(F.col("text")))
    marks = sorted({w for r in known.select(ngrams("w", 2).alias("g")).collect() for w in r["g"] if " " in w})
    # each notice whole, and without its first or last third
    cut = F.expr("greatest(2, cast(ceil(size(w) * 2 / 3) as int))")
    views = known.select("family", F.explode(F.array("w", F.slice("w", F.lit(1), cut), F.reverse(F.slice(F.reverse("w"), F.lit(1), cut)))).alias("w"))
    views = views.withColumn("g", ngrams("w"))
    grams = {x for r in views.select("g").collect() for x in r["g"]}

    few_pairs = F.size(F.filter("g", lambda x: x.isin(marks))) < 2
    # a paragraph that holds several word pairs of a notice may be one
    held = line_grams(lines, sorted(grams | set(marks)))
    held = held.select("g", few_pairs.alias("other"))
    n_other = held.where("other").count()
    often = {r["x"] for r in held.where("other").select(F.explode("g").alias("x")).groupBy("x").count().where(f"count > {common * n_other}").collect()}
    vocabulary = grams - often
    single = {x for x in vocabulary if " " not in x}
    vocabulary = sorted(x for x in vocabulary if not single.isdisjoint(x.split(" ")))  # no n-grams of common words only
    # paragraphs that hold the same known n-grams count as one row, as heavy as all of them
    sets = written(held.select(F.filter("g", lambda x: x.isin(vocabulary)).alias("g"), "other").groupBy("g", "other").agg(F.count(F.lit(1)).alias("n")), "licence-sets")
    names = [UNKNOWN, *sorted(families)]
    label = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("family")).cast("double") - 1
    # every class has rows, also without any paragraph: one without n-grams is unknown
    rows = views.select(label.alias("label"), "g", F.lit(1.0).alias("weight")).unionByName(
        spark.range(1).select(F.lit(0.0).alias("label"), F.expr("cast(array() as array<string>)").alias("g"), F.lit(3.0).alias("weight"))).coalesce(1)
    rows = rows.unionByName(sets.where("other").select(F.lit(0.0).alias("label"), "g", (F.col("n") * F.lit(len(names) * 3.0 / max(1, n_other))).alias("weight")))
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="g", outputCol="features").setBinary(True)
    fit = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60, weightCol="weight", standardization=False).fit(
        vectors.transform(rows).select("label", "features", "weight"))
    matrix = fit.coefficientMatrix.toArray()
    model = {"names": names, "intercepts": [float(v) for v in fit.interceptVector.toArray()], "learnt": n_other,
             "weights": [(g, [float(v) for v in matrix[:, i]]) for i, g in enumerate(vocabulary)]}
    model["single"] = sorted(single)
    model["longest"] = max(len(r["w"]) for r in known.select("w").collect())
    check = fit.transform(vectors.transform(sets.where(F.size("g") > 0).where(few_pairs))).select("n", vector_to_array("probability").alias("p"))
    # probabilities down to a millionth, so that the values to count are bounded
    sure = F.when(F.array_position("p", F.array_max("p")) == 1, 0.0).otherwise(F.floor(F.array_max("p") * 1e6) / 1e6)
    high = check.groupBy(sure.alias("p")).agg(F.sum("n").alias("n")).agg(F.expr(f"percentile(p, {1 - false_rate}, n)").alias("p")).first()["p"]
    model["threshold"] = max(0.5, high or 0.0)
    return model


def scored(paragraphs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, row, paragraph, n_lines, held, family, probability) of the rows of ``windows``: their known n-grams,
    the likeliest class and its probability.  Every known n-gram holds a known single word, so lines without one
    need no row.  The weight table, which is bounded by the notices, is sent to all tasks."""
    names, by = model["names"], ["doc_id", "row", "paragraph", "n_lines"]
    known = F.from_json(F.lit(json.dumps(dict(model["weights"]))), "map<string,array<double>>")
    weights = paragraphs.sparkSession.range(1).select(F.explode(known).alias("gram", "weight"))
    near = paragraphs.select(*by, F.explode(ngrams("w")).alias("gram"))
    sums = near.join(F.broadcast(weights), "gram").groupBy(*by).agg(
        F.collect_set("gram").alias("held"),
        *[(F.sum(F.col("weight")[i]) + F.lit(v)).alias(f"class{i}") for i, v in enumerate(model["intercepts"])])
    sums = sums.select(*by, "held", F.array(*[F.col(f"class{i}") for i in range(len(names))]).alias("score"))
    best = F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position("score", F.array_max("score")).cast("int"))
    odds = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("score")))
    return sums.select(*by, "held", best.alias("family"), (1 / odds).alias("probability"))


def similarity(families: dict[str, list[str]], vocabulary: list[str]) -> Column:
    """Largest share of the word pairs of one of ``family``'s templates that ``held`` holds."""
    known, out = set(vocabulary), F.lit(0.0)
    for family, texts in families.items():
        shares = [F.lit(0.0)]
        for text in texts:
            w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
            pairs = sorted({p for p in map(" ".join, zip(w, w[1:])) if p in known})
            if pairs:
                shares.append(F.size(F.array_intersect("held", F.array(*[F.lit(x) for x in pairs]))) / len(pairs))
        out = F.when(F.col("family") == family, F.array_max(F.array(*shares))).otherwise(out)
    return out


def tightest(found: DataFrame, most_lines: int) -> DataFrame:
    """``found`` without the findings that hold another one with at least their share (among equal spans there is
    one finding only), then without those inside a remaining one with a larger share.  Findings meet by the line
    they hold in cells of ``most_lines`` lines, so a text full of notices never meets itself whole."""
    at = ["doc_id", "row"]

    def cells(rows: DataFrame) -> DataFrame:
        spans = rows.select(*at, F.col("paragraph").alias("lo"), (F.col("paragraph") + F.col("n_lines") - 1).alias("hi"), "similarity")
        return spans.withColumn("cell", F.floor(F.col("lo") / most_lines))

    def without(rows: DataFrame, outer_goes: bool) -> DataFrame:
        outer = cells(rows).where("hi > lo").select(*at, F.col("lo").alias("lo_o"), F.col("hi").alias("hi_o"), F.col("similarity").alias("sim_o"),
                                                   F.explode(F.sequence("cell", F.floor(F.col("hi") / most_lines))).alias("cell"))
        inside = (F.col("lo_o") <= F.col("lo")) & (F.col("hi") <= F.col("hi_o")) & (F.col("hi_o") - F.col("lo_o") > F.col("hi") - F.col("lo"))
        met = cells(rows).join(outer, [*at, "cell"]).where(inside)
        gone = met.where("similarity >= sim_o").select(*at, "lo_o", "hi_o") if outer_goes else met.where("similarity < sim_o").select(*at, "lo", "hi")
        gone = gone.distinct().toDF(*at, "paragraph", "hi").select(*at, "paragraph", (F.col("hi") - F.col("paragraph") + 1).alias("n_lines"))
        return rows.join(gone, [*at, "paragraph", "n_lines"], "left_anti")

    return without(without(found, True), False)


def scan(docs: DataFrame, families: dict[str, list[str]] | None = None, id_col: str = "doc_id", text_col: str = "text",
         min_similarity: float = 0.6) -> DataFrame:
    """(doc_id, paragraph, n_lines, family, probability, similarity, confirmed): one row for each paragraph, named by its
    first line (from 0) and number of lines, in which the calibrated classifier sees a licence family."""
    families = families or NOTICES
    texts = bodies(docs, id_col, text_col)
    model = train(texts.select(F.explode("lines").alias("text")).where("trim(text) != ''"), families)
    found = scored(windows(texts, model["single"], model["longest"]), model)
    found = found.where((F.col("family") != UNKNOWN) & (F.col("probability") >= model["threshold"]))
    found = found.withColumn("similarity", similarity(families, [g for g, _ in model["weights"]]))
    # a window of lines is a paragraph only if it holds a notice
    found = found.where((F.col("n_lines") == 1) | (F.col("similarity") >= min_similarity))
    found = tightest(written(found.drop("held"), "licence-findings"), model["longest"] + 2)
    return found.select("doc_id", "paragraph", "n_lines", "family", "probability", "similarity", (F.col("similarity") >= min_similarity).alias("confirmed"))
