"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Passages around a licence cue are cut from every text.  Their words are weighed by term and inverse document frequency, the
latter counted over the whole corpus for the templates' words; a passage's cosine with each template is a join with the
templates' few weights.  Of the words that tell versions and variants apart both sides should have the same: each that only one
has lowers the similarity.  A passage is a line around a cue or a whole paragraph with one.  A file takes the licence of its best passage at or above ``LEAST``.  A file that consists mostly
of that passage, or whose name says so, is a licence file and speaks for its directory.  Files without a licence of
their own inherit from the nearest directory above that has one: directories, not files, are matched with their
ancestors, and files then look up their directory.

Everything is DataFrame functions.  The templates' weights are a few hundred rows; nothing else is broadcast.

Edge cases: a null or empty text has no passages; a null path has no directory and inherits nothing; of equal
cosines the first licence by name wins; a directory with several licence files takes the best, then the first by name.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelake.llm.common import staged

# Statements of common licences as they stand in file headers, licence files and machine-readable tags.
STATEMENTS = (
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License as published by the Free Software Foundation, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 terms and conditions for use, reproduction, and distribution"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD license"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution NoDerivatives 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution ShareAlike 4.0 International License"),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal, Creative Commons public domain dedication"),
    ("EPL-2.0", "This program is made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "GNU General Public License as published by the Free Software Foundation, either version 2 of the License"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("ISC", "Released under the ISC License"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, ISC License"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "GNU Lesser General Public License as published by the Free Software Foundation, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License as published by the Free Software Foundation, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, MIT License"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved"),
    ("Unlicense", "This is free and unencumbered software released into the public domain, Unlicense"),
)
TEMPLATES = STATEMENTS + tuple(
    (name, f"SPDX-License-Identifier: {name}") for name in sorted({name for name, _ in STATEMENTS} - {"Proprietary"})
)
# Words that tell versions and variants of one family apart.
DECIDING = (
    "1 2 2.1 3 4 affero agpl lesser lgpl library sharealike sa noncommercial nc noderivatives nd clause cc0 isc mit apache bsd "
    "mozilla mpl eclipse epl unlicense gpl general creative cc"
).split()
# Names that mean the same words.
SAME = (
    ("gnu affero general public license", "agpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu library general public license", "lgpl"),
    ("gnu general public license", "gpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("creative commons zero", "cc0"),
    ("creative commons attribution", "cc by"),
    ("noncommercial", "nc"),
    ("non-commercial", "nc"),
    ("sharealike", "sa"),
    ("share-alike", "sa"),
    ("noderivatives", "nd"),
    ("licence", "license"),
)
#: A cue with up to eighty characters of its line on either side.
PASSAGE = r"(?i)[^\n]{0,80}(?:licen[cs]e|spdx|permission is hereby|permission to use|redistribution and use|rights reserved)[^\n]{0,80}"
TERM = r"[a-z0-9]+(?:\.[a-z0-9]+)*"
#: A similarity is taken times this for every deciding word that only one side has.
DISAGREED = 0.75
#: Parts of a directory that look up its licence apart from each other.
PARTS = 32
LEAST = 0.6
#: Share of a file's words that its passage has to hold to make it a licence file.
MOSTLY = 0.8
LICENCE_NAME = r"(?i)(?:^|/)(?:licen[cs]e|copying|notice)[^/]*$"


def has_cue(text: Column) -> Column:
    """Whether a text can hold a passage; a search for six plain strings, as few texts do."""
    folded = F.lower(text)
    cues = ("licen", "spdx", "permission is hereby", "permission to use", "redistribution and use", "rights reserved")
    return reduce(or_, (F.contains(folded, F.lit(cue)) for cue in cues))


def terms(text: Column) -> Column:
    """Words of a statement: identifiers are cut at hyphens, ``v2``, ``2.0`` and ``2`` are one version, long names are short ones."""
    folded = F.regexp_replace(F.lower(text), r"\s+", " ")
    for name, short in SAME:
        folded = F.replace(folded, F.lit(name), F.lit(short))
    plain = F.regexp_replace(F.regexp_replace(folded, r"(?<=gpl)v(?=[0-9])|\bv(?=[0-9])", " "), r"\b([0-9]+)\.0\b", "$1")
    return F.regexp_extract_all(plain, F.lit(TERM), F.lit(0))


def deciding(words: Column) -> Column:
    return F.array_intersect(words, F.array(*map(F.lit, DECIDING)))


def frequencies(files: DataFrame, text: str) -> tuple[DataFrame, int]:
    """(``term``, ``df``) over all files for the terms of the templates, and the number of files."""
    spark = files.sparkSession
    wanted = spark.createDataFrame(TEMPLATES, "licence string, statement string")
    vocabulary = wanted.select(F.explode(terms(F.col("statement"))).alias("term")).distinct()
    listed = sorted(r["term"] for r in vocabulary.collect())
    held = F.array_intersect(terms(F.coalesce(F.col(text), F.lit(""))), F.array(*map(F.lit, listed)))
    counted = files.select(F.explode(held).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    count = files.count()
    return F.broadcast(vocabulary).join(counted, "term", "left").select("term", F.coalesce("df", F.lit(0)).alias("df")), count


def matches(files: DataFrame, text: str) -> DataFrame:
    """Best licence of each file that has one: ``row``, ``licence``, ``similarity``, ``length`` (words of the passage)."""
    spark = files.sparkSession
    counted, total = frequencies(files, text)
    highest = F.log(F.lit(total + 1.0))
    idf = staged(counted.select("term", (F.log((F.lit(total) + 1.0) / (F.col("df") + 1.0)) + 0.1).alias("idf")), "licence-idf")
    templates = (
        spark.createDataFrame([(i, *t) for i, t in enumerate(TEMPLATES)], "template int, licence string, statement string")
        .select("template", "licence", F.explode(terms(F.col("statement"))).alias("term"))
        .groupBy("template", "licence", "term")
        .agg(F.count("*").alias("tf"))
        .join(idf, "term")
        .withColumn("w", F.col("tf") * F.col("idf"))
        .withColumn("unit", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("template"))))
    )
    templates = staged(templates.select("template", "licence", "term", "unit"), "licence-templates")
    # Lines around a cue, and the paragraphs that hold one.
    paragraphs = F.filter(F.split(F.col(text), r"\n[ \t\r]*\n"), has_cue)
    found = F.array_distinct(F.concat(F.regexp_extract_all(F.col(text), F.lit(PASSAGE), F.lit(0)), paragraphs))
    passages = files.where(has_cue(F.col(text))).select("row", F.posexplode(found).alias("number", "passage"))
    words = passages.select("row", "number", terms(F.col("passage")).alias("words"))
    weighed = staged(
        words.select("row", "number", F.size("words").alias("length"), F.explode("words").alias("term"))
        .groupBy("row", "number", "length", "term")
        .agg(F.count("*").alias("tf"))
        .join(F.broadcast(idf), "term", "left")
        .withColumn("w", F.col("tf") * F.coalesce("idf", highest + 0.1)),
        "licence-terms",
    )
    # Words that no template holds are noise around the statement; they count half.
    square = F.when(F.col("idf").isNull(), F.col("w") * F.col("w") / 4).otherwise(F.col("w") * F.col("w"))
    told = F.collect_set(F.when(F.col("term").isin(DECIDING), F.col("term")))
    norms = weighed.groupBy("row", "number").agg(F.sqrt(F.sum(square)).alias("norm"), told.alias("told"))
    own = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(TEMPLATES)], "template int, statement string")
    own = own.select("template", deciding(terms(F.col("statement"))).alias("own"))
    products = (
        weighed.join(F.broadcast(templates), "term")
        .groupBy("row", "number", "length", "template", "licence")
        .agg(F.sum(F.col("w") * F.col("unit")).alias("dot"))
    )
    apart = F.size(F.array_except("own", "told")) + F.size(F.array_except("told", "own"))
    similar = F.col("dot") / F.col("norm") * F.pow(F.lit(DISAGREED), apart)
    scored = products.join(norms, ["row", "number"]).join(F.broadcast(own), "template").withColumn("similarity", F.round(similar, 6))
    best = F.max(F.struct(F.col("similarity"), (-F.col("template")).alias("turn"), F.col("licence"), F.col("length"))).alias("best")
    return scored.where(F.col("similarity") >= LEAST).groupBy("row").agg(best).select("row", "best.licence", "best.similarity", "best.length")


def scan(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """``files`` without their text, with ``licence``, ``similarity``, ``origin`` (own, inherited, none) and ``directory``.

    ``directory`` is the one that an inherited licence comes from.
    """
    rest = [c for c in files.columns if c not in (text, "licence", "similarity", "origin", "directory")]
    # The file's own columns travel as one, so that no name of theirs can clash with one of these.
    kept = files.select(F.struct(*rest).alias("file"), F.col(path).alias("path"), F.col(text).alias("text"))
    kept = kept.withColumn("row", F.xxhash64("path", "text"))
    # Files with the same path and text have the same row number and the same licence.
    own = staged(matches(kept.select("row", "text"), "text").dropDuplicates(["row"]), "licence-matches")
    parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    words = F.when(has_cue(F.col("text")), F.size(terms(F.col("text"))))
    named = staged(
        kept.select(
            "file", "path", "row", words.alias("words"), F.when(F.contains("path", F.lit("/")), parent).when(F.col("path").isNotNull(), "").alias("parent")
        ).join(own, "row", "left"),
        "licence-files",
    )
    speaks = F.col("path").rlike(LICENCE_NAME) | (F.col("length") >= MOSTLY * F.col("words"))
    given = (
        named.where(F.col("licence").isNotNull() & F.col("parent").isNotNull() & speaks)
        .groupBy(F.col("parent").alias("directory"))
        .agg(F.max_by("licence", F.struct("similarity", F.col("licence"))).alias("inherited"))
    )
    above = named.select("parent").where("parent is not null").distinct()
    names = F.split("parent", "/")
    ancestors = above.select("parent", F.explode(F.sequence(F.lit(0), F.size(names))).alias("depth")).select(
        "parent", "depth", F.array_join(F.slice(names, F.lit(1), F.col("depth")), "/").alias("directory")
    )
    nearest = (
        ancestors.join(given, "directory")
        .groupBy("parent")
        .agg(F.max(F.struct("depth", "directory", "inherited")).alias("from"))
        .select("parent", "from.directory", "from.inherited", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    )
    done = named.withColumn("part", F.pmod("row", F.lit(PARTS)).cast("int")).join(nearest, ["parent", "part"], "left")
    mine = F.col("licence").isNotNull()
    return done.select(
        *(F.col("file")[c].alias(c) for c in rest),
        F.coalesce("licence", "inherited").alias("licence"),
        F.when(mine, F.col("similarity")).alias("similarity"),
        F.when(mine, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("directory")).alias("directory"),
    )
