"""License scan: TF-IDF cosine to templates, and inheritance from the nearest directory above.

1. Files are cut into lines and sentences. Each passage, and the whole file, is a unit. Units and
   templates become sparse vectors of term weights; the document frequencies are counted over all
   passages and templates. The most similar template above ``SIMILAR`` is the license of a file. Units that cannot
   reach it are left out before their terms are joined: the weights of template terms and of the
   ``FREQUENT`` most frequent ones are known, and any other term of a unit weighs at least what the
   next frequent one does, so each cosine has an upper bound.
2. A file whose name or whole text is that of a license speaks for its directory. Files without a
   license of their own inherit from the nearest directory above that has one. Directories are
   joined, not files: each distinct directory meets its ancestors once, however many files it has.

The files are read twice, for the frequencies and for the units. The terms of the templates reach all
tasks as a constant, so templates are meant to be hundreds of words, not whole libraries.

Nulls and edge cases: null and empty texts have no license of their own and may inherit. A null
path has no directory and inherits nothing. Equal similarities are settled by the name of the
license. Rows that share an id or a path are separate files. Other columns are ignored. Long texts
are units as a whole like others.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carebase.llm.text import let, pieces, words
from carebase.session import written

SIMILAR = 0.6
# From here on a whole text is a license, and not a file that has one.
WHOLE = 0.85
LICENSE_FILE = r"(?i)(?:^|/)(?:licen[sc]e|copying|unlicense)(?:\.[a-z]+)?$"
PASSAGE = r"\n|(?<=[.!?])\s+"
# Upper bounds are compared with a little less, for the order of sums.
SLACK = 1 - 1e-6
FREQUENT = 256
# Files of one directory meet its license in so many slices.
SLICES = 16

# Public license names, each with statements that grant or head it.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved. No license is granted."),
)


def default_templates(spark: SparkSession) -> DataFrame:
    """(license, text)"""
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(license, text)")


def _parts(text: Column) -> Column:
    """The passages of a text and then the text itself."""
    return F.concat(pieces(text, PASSAGE), F.array(text))


def _frequencies(files: DataFrame, templates: DataFrame) -> tuple[DataFrame, int]:
    """(term, idf) over all passages and templates, stored, and the number of both."""
    known = files.select(F.explode(pieces(F.col("text"), PASSAGE)).alias("part"))
    # The empty word, which no text has, counts the passages in the same pass.
    listed = known.union(templates.where("text IS NOT NULL").select("text")).select(
        F.explode(F.array_append(F.array_distinct(words(F.col("part"))), F.lit(""))).alias("term")
    )
    counts = written(listed.groupBy("term").agg(F.count("*").alias("n")), "frequencies")
    n = (counts.where("term = ''").first() or [None, 0])[1]
    idf = (F.log((F.lit(n) + 1.0) / (F.col("n") + 1.0)) + 1.0).alias("idf")
    return counts.where("term <> ''").select("term", idf), n


def _may_match(idf: DataFrame, templates: DataFrame, similar: float) -> Callable[[Column], Column]:
    """A test of a unit's words that holds for all units that are similar to a template.

    First a unit must have one of the telling terms: those that remain when the most common terms are
    left out, as many as leave every template's other terms a length below ``similar``; without any
    telling term no cosine can reach it. Then lengths are compared.
    With v the weights of a unit in known terms, its length is at least the root of the sum of v * v and
    of ``rest * rest`` for each other term, where ``rest`` is the idf of the most frequent of these. The sum
    of v times the largest weight of each term in any template is held against that, with bounds of the
    term frequencies; then the dot product with each template, with the frequencies themselves.
    """
    listed = templates.where("text IS NOT NULL").select("text", words(F.col("text")).alias("terms"))
    known = listed.select(F.explode("terms").alias("term")).distinct().join(idf, "term")
    of_templates = known.collect()
    ordered = idf.orderBy("idf", "term").limit(FREQUENT + 1).collect()
    rest = ordered[FREQUENT].idf if len(ordered) > FREQUENT else 1.0
    weights = {row.term: row.idf for row in of_templates + ordered[:FREQUENT]}
    vectors = []
    for row in listed.select("terms").collect():
        raw = {t: (1 + math.log(n)) * weights[t] for t, n in Counter(row.terms).items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append({t: w / norm for t, w in raw.items()})
    if not of_templates:
        return lambda terms: F.lit(False)

    common, lengths = set(), [0.0] * len(vectors)
    for term in sorted({row.term for row in of_templates}, key=lambda t: (weights[t], t)):
        grown = [x + v.get(term, 0.0) ** 2 for x, v in zip(lengths, vectors, strict=True)]
        if max(grown) >= (similar * SLACK) ** 2:
            break
        lengths = grown
        common.add(term)

    # Words have no quotes or backslashes; one text per constant is quicker than many calls.
    def array(values: Iterable[str]) -> str:
        return f"array({', '.join(values)})"

    def mapped(values: Mapping[str, str]) -> str:
        return f"map({', '.join(f"'{term}', {value}" for term, value in values.items())})"

    telling = F.expr(array(sorted(f"'{row.term}'" for row in of_templates if row.term not in common)))
    terms_of = F.expr(array(f"'{term}'" for term in weights))
    idf_of = F.expr(mapped({term: f"{w!r}D" for term, w in weights.items()}))
    # What a term adds to a dot product at most, and to the square of the length at least.
    most = {t: max(v.get(t, 0.0) for v in vectors) for t in weights}
    bound = {
        t: f"named_struct('dot', {w * most[t]!r}D, 'square', {w * w!r}D)" for t, w in weights.items()
    }
    bounds = F.expr(mapped(bound))
    each = F.expr(array(mapped({t: f"{w!r}D" for t, w in v.items()}) for v in vectors if v))

    def summed(values: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda total, v: total + of(v))

    def test(terms: Column) -> Column:
        spaced = F.concat(F.lit(" "), F.array_join(terms, "  "), F.lit(" "))

        def repeats(joined: Column, term: Column) -> Column:
            single = F.concat(F.lit(" "), term, F.lit(" "))
            left = F.length(F.replace(joined, single, F.lit("")))
            return (F.length(joined) - left) / F.length(single)

        def weighed(shared: Column, distinct: Column) -> Column:
            once = F.size(terms) == distinct
            return let(
                F.when(once, F.lit("")).otherwise(spaced),
                lambda joined: F.transform(
                    shared,
                    lambda t: F.struct(
                        t.alias("term"),
                        (F.element_at(idf_of, t) * F.when(once, F.lit(1.0)).otherwise(1 + F.log(repeats(joined, t)))).alias("v"),
                    ),
                ),
            )

        def reaches(values: Column, others: Column) -> Column:
            length = F.sqrt(summed(values, lambda x: x["v"] * x["v"]) + others * (rest * rest))
            return let(
                length * (similar * SLACK),
                lambda least: F.exists(
                    each,
                    lambda vector: summed(
                        values, lambda x: x["v"] * F.coalesce(F.try_element_at(vector, x["term"]), F.lit(0.0))
                    )
                    >= least,
                ),
            )

        def plausible(shared: Column, distinct: Column) -> Column:
            start = F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("square"))
            total = F.aggregate(
                F.transform(shared, lambda t: F.element_at(bounds, t)),
                start,
                lambda a, x: F.struct((a["dot"] + x["dot"]).alias("dot"), (a["square"] + x["square"]).alias("square")),
            )
            most_often = 1 + F.log(F.size(terms) - distinct + 1)
            others = (distinct - F.size(shared)) * (rest * rest)
            return let(
                total, lambda x: x["dot"] * most_often >= F.sqrt(x["square"] + others) * (similar * SLACK)
            )

        def bounded(shared: Column) -> Column:
            return let(
                F.size(F.array_distinct(terms)),
                lambda d: plausible(shared, d)
                & let(weighed(shared, d), lambda v: reaches(v, d - F.size(shared))),
            )

        return F.arrays_overlap(terms, telling) & let(F.array_intersect(terms, terms_of), bounded)

    return test


def _counted(units: DataFrame, *key: str) -> DataFrame:
    """(key, term, tf) with a damped term frequency."""
    listed = units.select(*key, F.explode("terms").alias("term"))
    counts = listed.groupBy(*key, "term").agg(F.count("*").alias("n"))
    return counts.select(*key, "term", (1 + F.log("n")).alias("tf"))


def _weighted(counted: DataFrame, idf: DataFrame, *key: str) -> DataFrame:
    """(key, term, weight), each vector of length one."""
    raw = counted.join(idf, "term").withColumn("weight", F.col("tf") * F.col("idf"))
    norms = raw.groupBy(*key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return raw.join(norms, list(key)).select(*key, "term", (F.col("weight") / F.col("norm")).alias("weight"))


def own_licenses(
    units: DataFrame, idf: DataFrame, templates: DataFrame, similar: float = SIMILAR
) -> DataFrame:
    """(row, license, similarity, is_license) of the files that are similar to a template.

    ``units`` has row, unit, whole and terms; ``is_license`` tells that the whole text is the license.
    """
    terms = written(_counted(units, "row", "unit", "whole"), "terms")
    named = templates.where("text IS NOT NULL").select(
        F.md5(F.concat_ws(":", "license", "text")).alias("template"), "license", words(F.col("text")).alias("terms")
    )
    template_terms = written(_counted(named, "license", "template"), "templates")
    ours = _weighted(terms, idf, "row", "unit", "whole")
    theirs = _weighted(template_terms, idf, "license", "template")
    theirs = theirs.withColumnRenamed("weight", "other")
    cosines = (
        ours.join(theirs, "term")
        .groupBy("row", "unit", "whole", "license", "template")
        .agg(F.sum(F.col("weight") * F.col("other")).alias("cosine"))
        .where(F.col("cosine") >= similar)
    )
    # Rounded, so that equal passages do not differ by the order of a sum.
    rank = F.struct((-F.round("cosine", 9)).alias("far"), "license")
    best = cosines.groupBy("row").agg(
        F.min(rank).alias("best"),
        F.max(F.col("whole") & (F.col("cosine") >= WHOLE)).alias("is_license"),
    )
    return best.select(
        "row", "best.license", (-F.col("best.far")).alias("similarity"), "is_license"
    )


def _directory(path: str):
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherited_licenses(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(directory, license) for the directories that have a license or lie below one that has.

    ``licensed`` has directory, license, similarity, and named, for files named like a license,
    which come first.
    """
    rank = F.struct((~F.col("named")).alias("other"), (-F.col("similarity")).alias("far"), "license")
    holders = licensed.groupBy("directory").agg(F.min(rank)["license"].alias("license"))
    levels = F.split("directory", "/")
    above = F.transform(
        F.sequence(F.size(levels), F.lit(1), F.lit(-1)),
        lambda k: F.array_join(F.slice(levels, F.lit(1), k), "/"),
    )
    ancestors = directories.select("directory", F.posexplode(F.concat(above, F.array(F.lit("")))).alias("up", "above"))
    met = ancestors.join(holders.withColumnRenamed("directory", "above"), "above")
    return met.groupBy("directory").agg(F.min_by("license", "up").alias("license"))


def scan_licenses(
    files: DataFrame, templates: DataFrame | None = None, similar: float = SIMILAR
) -> DataFrame:
    """(doc_id, path, license, similarity, origin) of every file; origin is own, inherited or none.

    ``files`` has doc_id, path and text.
    """
    spark = files.sparkSession
    templates = default_templates(spark) if templates is None else templates
    idf, _ = _frequencies(files, templates)
    may_match = _may_match(idf, templates, similar)

    def unit(part: Column, i: Column, n: Column) -> Column:
        return let(
            words(part),
            lambda terms: F.when(
                may_match(terms),
                F.struct(i.alias("unit"), (i == n - 1).alias("whole"), terms.alias("terms")),
            ),
        )

    units = let(
        _parts(F.col("text")),
        lambda parts: F.array_compact(F.transform(parts, lambda part, i: unit(part, i, F.size(parts)))),
    )
    kept = written(
        files.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "path",
            F.when(F.col("text").isNotNull(), units).alias("units"),
        ),
        "units",
    )
    listed = kept.select("row", F.explode("units").alias("u")).select("row", "u.*")
    own = written(own_licenses(listed, idf, templates, similar), "own")
    placed = kept.select("row", "doc_id", "path", _directory("path").alias("directory"))
    found = written(placed.join(own, "row", "left"), "found")
    licensed = found.where("license IS NOT NULL AND path IS NOT NULL").withColumn(
        "named", F.col("path").rlike(LICENSE_FILE)
    )
    licensed = licensed.where("is_license OR named")
    directories = found.where("license IS NULL AND path IS NOT NULL").select("directory").distinct()
    above = inherited_licenses(directories, licensed).withColumnRenamed("license", "above")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("above").isNotNull(), "inherited")
    spread = above.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    sliced = found.withColumn("slice", F.pmod("row", F.lit(SLICES)).cast("int"))
    joined = sliced.join(spread, ["directory", "slice"], "left")
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("license", "above").alias("license"),
        "similarity",
        origin.otherwise("none").alias("origin"),
    )


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """Documents as files, in a directory per language below one per source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan_licenses(docs.select("doc_id", path.alias("path"), "text"))
