"""Licence scan: a trained paragraph classifier with an unknown class, confirmed against templates.

A paragraph (line) is a sparse vector of its word n-grams. A multinomial
logistic regression, fitted with the library's own DataFrame estimator on the
templates below and on paragraphs of the corpus as the unknown class, gives a
family; its probabilities are calibrated by one temperature on held-out rows.
A family found is confirmed by comparing the paragraph with the family's
templates. Only n-grams with a telling word are features, so a paragraph
without one has no feature and is unknown by the intercepts alone: it is left
out before vectors are made, with no change to the result. DataFrame and SQL
functions only.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import materialize

UNKNOWN = "unknown"
#: Documents at most whose paragraphs stand for the unknown class, and paragraphs taken from them.
UNKNOWN_DOCS, UNKNOWN_ROWS = 400, 3_000
#: Calibrated probability a family needs, and share of a paragraph's word pairs found in a template.
LEAST_PROBABILITY, LEAST_SHARED = 0.6, 0.5

# Usual statements of each licence family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under the GPL v2.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL.",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the MPL 2.0.",
    ),
    "cc": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Released under CC BY-SA 3.0.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "Dedicated to the public domain under CC0 1.0.",
    ),
}

# Words too common to tell anything.
_COMMON = frozenset(
    "a an and any are as at be by can either for free found from in into is it later met may not of on or s see or style that "
    "the this to use v with without you work file form forms copy person charge deal terms following either project program "
    "details except provided 0 1 2 3 4".split()
)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _python_words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def telling_words() -> list[str]:
    return sorted({w for texts in TEMPLATES.values() for t in texts for w in _python_words(t)} - _COMMON)


def ngrams(found: Column, n: int) -> Column:
    """Runs of n words, joined by spaces."""
    return F.transform(
        _starts(found, n),
        lambda i: F.concat_ws(" ", F.slice(found, i + 1, n)),
    )


def _starts(found: Column, n: int) -> Column:
    none = F.array().cast("array<int>")
    return F.when(F.size(found) >= n, F.sequence(F.lit(0), F.size(found) - n)).otherwise(none)


def _vocabulary() -> list[str]:
    telling, out = set(telling_words()), set()
    for texts in TEMPLATES.values():
        for t in texts:
            w = _python_words(t)
            out |= {x for x in w if x in telling}
            out |= {f"{x} {y}" for x, y in zip(w, w[1:]) if x in telling or y in telling}
    return sorted(out)


def _vectors(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``_words``) plus the sparse counts of its n-grams."""
    model = CountVectorizerModel.from_vocabulary(_vocabulary(), inputCol="_grams", outputCol="_vector")
    return model.transform(rows.withColumn("_grams", F.concat("_words", ngrams(F.col("_words"), 2)))).drop("_grams")


def _pairs(text: str) -> Column:
    w = _python_words(text)
    return F.array(*[F.lit(f"{x} {y}") for x, y in zip(w, w[1:])])


def _best_share(pairs: Column, templates: Column) -> Column:
    """Largest share of the paragraph's word pairs that one of the templates holds."""
    most = F.array_max(F.transform(templates, lambda t: F.size(F.array_intersect(pairs, t))))
    return most / F.greatest(F.size(pairs), F.lit(1))


class Scanner:
    """The fitted regression, the names of its classes and the calibration temperature."""

    def __init__(self, model: LogisticRegressionModel, temperature: float):
        self.model, self.temperature = model, temperature
        self.names = [UNKNOWN, *TEMPLATES]

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """Adds ``_p``: calibrated probability of each class."""
        raw = self.model.transform(_vectors(rows)).withColumn("_raw", F.transform(vector_to_array("rawPrediction"), lambda x: x / self.temperature))
        top = F.array_max("_raw")
        raised = raw.withColumn("_e", F.transform("_raw", lambda x: F.exp(x - top)))
        total = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
        return raised.withColumn("_p", F.transform("_e", lambda x: x / total)).drop("_vector", "_raw", "_e", "rawPrediction", "probability", "prediction")


def train(docs: DataFrame, key: str, text: str) -> Scanner:
    """Fits on all templates, whole and in part, and on a bounded number of corpus paragraphs as unknown."""
    spark: SparkSession = docs.sparkSession
    names = [UNKNOWN, *TEMPLATES]
    rows = [(float(names.index(f)), t) for f, texts in TEMPLATES.items() for t in texts]
    whole = spark.createDataFrame(rows, "label double, _text string").withColumn("_words", words(F.col("_text")))
    # Parts of templates, so that a shortened or a continued statement is known too.
    part = whole.select("label", "_words", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("cut"))
    part = part.select("label", F.slice("_words", F.lit(1), F.greatest(F.size("_words") - F.col("cut"), F.lit(4))).alias("_words"), "cut")
    sample = docs.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    sample = sample.orderBy(F.xxhash64("_key"), "_key", "_text").limit(UNKNOWN_DOCS)
    lines = sample.select("_key", F.explode(F.split("_text", "\n")).alias("_line")).select("_key", words(F.col("_line")).alias("_words"))
    # Written before each step that reads its words again and again.
    lines = materialize(lines.where(F.size("_words") > 0), "licence-lines")
    lines = materialize(lines.withColumn("_pairs", F.array_distinct(ngrams(F.col("_words"), 2))), "licence-pairs")
    every = F.array(*[_pairs(t) for texts in TEMPLATES.values() for t in texts])
    other = lines.where(_best_share(F.col("_pairs"), every) < LEAST_SHARED)
    other = other.orderBy(F.xxhash64("_words"), "_words").limit(UNKNOWN_ROWS).select(F.lit(0.0).alias("label"), "_words", F.pmod(F.xxhash64("_words"), F.lit(4)).cast("int").alias("cut"))
    # Statements about licences that grant none, so that the unknown class has features too.
    near = spark.createDataFrame([(0.0, t) for t in _NO_GRANT], "label double, _text string")
    near = near.select("label", words(F.col("_text")).alias("_words"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("cut"))
    made = materialize(part.unionByName(other).unionByName(near), "licence-train")
    weight = F.when((F.col("label") == 0) & ~F.arrays_overlap("_words", F.array(*map(F.lit, telling_words()))), 0.05).otherwise(1.0)
    fit = _vectors(made.where("cut <> 1").withColumn("_w", weight))
    model = LogisticRegression(
        featuresCol="_vector", labelCol="label", weightCol="_w", family="multinomial", regParam=0.01, elasticNetParam=0.0, maxIter=60
    ).fit(fit)
    held = made.where("cut = 1").withColumn("_w", weight)
    losses = []
    for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0):
        p = Scanner(model, t).probabilities(held)
        loss = p.agg(F.sum(-F.log(F.greatest(F.element_at("_p", F.col("label").cast("int") + 1), F.lit(1e-12))) * F.col("_w"))).first()[0]
        losses.append((loss if loss is not None else 0.0, t))
    return Scanner(model, min(losses)[1])


# Sentences with words of licences that name none.
_NO_GRANT = (
    "All rights reserved.", "The license of this software is not known.", "A driving license is required.",
    "The public domain of the function is open.", "General conditions of the public service.",
    "The foundation published a new version of its software.", "Source code and binary data.",
    "The commons is a place for the public.", "See the documentation for the version.", "No permission was granted.",
)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """Paragraphs of a licence family: ``key, line_no, family, probability, shared, confirmed, paragraph``.

    One row per line (from 0) whose calibrated probability of a family is
    ``LEAST_PROBABILITY`` or more; ``shared`` is the share of its word pairs in
    one template of that family, ``confirmed`` whether it reaches
    ``LEAST_SHARED``. Null texts have no lines; a null key stays null; repeated
    rows give repeated results; other columns are not read.
    """
    scanner = scanner or train(docs, key, text)
    lines = docs.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{key}`").alias("_key"), F.posexplode(F.split(F.col(f"`{text}`"), "\n")).alias("line_no", "paragraph"))
    told = lines.withColumn("_words", words(F.col("paragraph"))).where(F.arrays_overlap("_words", F.array(*map(F.lit, telling_words()))))
    told = materialize(told, "licence-told")
    p = materialize(scanner.probabilities(told).drop("_grams"), "licence-scored")
    best = F.array_max(F.slice("_p", 2, len(TEMPLATES)))
    named = p.withColumn("probability", F.round(best, 6)).withColumn("_class", F.array_position("_p", best).cast("int") - 1)
    named = named.where((F.col("probability") >= LEAST_PROBABILITY) & (F.element_at("_p", 1) < best))
    named = named.withColumn("family", F.element_at(F.array(*map(F.lit, scanner.names)), F.col("_class") + 1))
    named = materialize(named.withColumn("_pairs", F.array_distinct(ngrams(F.col("_words"), 2))), "licence-named")
    own = spark_templates(docs.sparkSession)
    compared = named.join(F.broadcast(own), "family").withColumn("shared", F.round(_best_share(F.col("_pairs"), F.col("_templates")), 6))
    return compared.select(
        F.col("_key").alias(key), "line_no", "family", "probability", "shared", (F.col("shared") >= LEAST_SHARED).alias("confirmed"), "paragraph"
    )


def spark_templates(spark: SparkSession) -> DataFrame:
    """One row per family (a fixed number): its templates as arrays of word pairs."""
    rows = []
    for family, texts in TEMPLATES.items():
        split = [_python_words(t) for t in texts]
        rows.append((family, [[f"{x} {y}" for x, y in zip(w, w[1:])] for w in split]))
    return spark.createDataFrame(rows, "family string, _templates array<array<string>>")
