"""Licence scan: sparse TF-IDF against templates, then inheritance down the directory tree.

Every line of every file is compared with licence templates by the cosine of TF-IDF vectors. Document
frequencies of the templates' terms come from all files; a term that no template has counts as unseen.
The best line is a file's own licence if its cosine reaches the threshold. A line can only reach it if it
has one of a template's rarest terms: the others together are too short for it, so lines without such an
anchor term are passed over without losing any.

A licence file speaks for its directory. A file without a licence of its own inherits from the nearest
ancestor directory that has a licence file: the ancestors of each distinct directory are joined with
the licensed directories, and the deepest one found wins.

Spark SQL expressions and joins only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.shared import only, write_once

THRESHOLD = 0.6

# Sentences that state a licence, by SPDX id.
TEMPLATES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    "GPL-2.0": ("This program is licensed under the GNU General Public License, version 2.",),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.",),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related rights to this work.", "CC0 1.0 Universal"),
}
# Terms: words of ASCII letters and digits, version numbers whole.
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def terms_in(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def _literals(values) -> str:
    return ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), 0)


def weigh(frequencies: dict[str, int], files: int, threshold: float = THRESHOLD, templates=None) -> tuple[dict, float, list[tuple[str, int, dict[str, float]]], set[str]]:
    """Term weights, the weight of an unseen term, the unit template vectors, and the anchor terms."""
    templates = TEMPLATES if templates is None else templates
    idf = {t: math.log((files + 1) / (frequencies.get(t, 0) + 1)) + 1.0 for said in templates.values() for x in said for t in terms_in(x)}
    unseen = math.log(files + 1) + 1.0
    vectors, anchors = [], set()
    for name, said in templates.items():
        for number, text in enumerate(said):
            found = terms_in(text)
            raw = {t: found.count(t) * idf[t] for t in found}
            norm = math.sqrt(sum(w * w for w in raw.values()))
            vector = {t: w / norm for t, w in raw.items()}
            vectors.append((name, number, vector))
            # From the commonest term on, as long as these alone stay short of the threshold.
            rest = 0.0
            for t in sorted(vector, key=lambda t: (idf[t], t)):
                rest += vector[t] ** 2
                if math.sqrt(rest) >= threshold:
                    anchors.add(t)
    return idf, unseen, vectors, anchors


def own_licences(files: DataFrame, threshold: float = THRESHOLD, templates=None) -> DataFrame:
    """``path, line, licence, similarity`` of the best licence line of each file that has one.

    Of lines or templates that are equally close, the first. Repeated paths are one file.
    """
    spark = files.sparkSession
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({t for said in templates.values() for x in said for t in terms_in(x)})
    texts = only(files, ["path", "text"]).where("text is not null and path is not null")
    # Rows of the size of the vocabulary.
    have = F.expr(f"array_intersect(__terms, array({_literals(vocabulary)}))")
    counted = texts.select(_terms(F.col("text")).alias("__terms")).select(F.explode(have).alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()
    idf, unseen, vectors, anchors = weigh({r["term"]: r["n"] for r in counted}, texts.count(), threshold, templates)
    anchored = r"(?<![a-z0-9])(?:" + "|".join(sorted(re.escape(a).replace("\\-", "-") for a in anchors)) + r")(?![a-z0-9])"
    lines = texts.where(F.lower("text").rlike(anchored)).select("path", F.posexplode(F.split("text", "\n")).alias("line", "said"))
    lines = lines.where(F.lower("said").rlike(anchored)).select("path", "line", _terms(F.col("said")).alias("terms"))
    # The line's own length: known terms by their weight, all others as unseen ones.
    term = spark.createDataFrame([(t, float(w)) for t, w in sorted(idf.items())], "term string, weight double")
    parts = lines.select("path", "line", F.explode("terms").alias("term")).groupBy("path", "line", "term").agg(F.count("*").alias("n"))
    weighed = parts.join(F.broadcast(term), "term", "left").withColumn("value", F.col("n") * F.coalesce("weight", F.lit(unseen)))
    lengths = weighed.groupBy("path", "line").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    entries = [(name, number, t, float(w)) for name, number, vector in vectors for t, w in sorted(vector.items())]
    template = spark.createDataFrame(entries, "licence string, number int, term string, share double")
    # The templates are fixed text, a few hundred terms.
    dots = weighed.where("weight is not null").join(F.broadcast(template), "term").groupBy("path", "line", "licence", "number").agg(
        F.sum(F.col("value") * F.col("share")).alias("dot"))
    close = dots.join(lengths, ["path", "line"]).withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("similarity") >= threshold)
    best = F.max_by(F.struct("line", "licence", "similarity"), F.struct("similarity", -F.col("line"), "licence"))
    return close.groupBy("path").agg(best.alias("b")).select("path", "b.line", "b.licence", "b.similarity")


def directory_of(path: Column) -> Column:
    """The path up to its last slash; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors_of(directory: Column) -> Column:
    """The directory, its parents and the top (an empty text)."""
    parts = F.filter(F.split(directory, "/"), lambda x: x != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan(files: DataFrame, is_licence_file: Column, threshold: float = THRESHOLD, templates=None) -> DataFrame:
    """``path, directory, own, similarity, line, inherited_from, licence`` for each path of ``files(path, text)``.

    ``is_licence_file`` says of a row whether its licence holds for the directory; of several in one,
    the closest to a template, then the first by path. ``licence`` is the own one, else the inherited
    one, else null. Null and empty texts have no licence of their own and inherit; rows without a path
    are left out, repeated paths are one file; an empty table gives an empty result. Other columns are ignored.
    """
    marked = files.select(F.col("path"), F.col("text"), F.coalesce(is_licence_file, F.lit(False)).alias("speaks")).where("path is not null")
    own = write_once(own_licences(marked, threshold, templates), "licences")
    paths = marked.groupBy("path").agg(F.max("speaks").alias("speaks")).withColumn("directory", directory_of(F.col("path")))
    known = paths.join(own, "path", "left")
    speaking = known.where("speaks and licence is not null").groupBy("directory").agg(
        F.min_by("licence", F.struct(-F.col("similarity"), "path")).alias("held"))
    above = paths.select("directory").distinct().withColumn("above", F.explode(ancestors_of(F.col("directory"))))
    nearest = above.join(speaking.withColumnRenamed("directory", "above"), "above").groupBy("directory").agg(
        F.max_by(F.struct("above", "held"), F.length("above")).alias("n"))
    return known.join(nearest, "directory", "left").select(
        "path", "directory", F.col("licence").alias("own"), "similarity", F.col("line").cast("long").alias("line"),
        F.when(F.col("licence").isNull(), F.col("n.above")).alias("inherited_from"), F.coalesce("licence", "n.held").alias("licence"),
    )
