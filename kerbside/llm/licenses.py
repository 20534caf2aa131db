"""Licence scan, with DataFrame functions only.

Lines of files are compared with licence templates by the cosine of sparse TF-IDF vectors
over the templates' words; document frequencies come from all files. A file whose best line
reaches ``THRESHOLD`` states that licence itself. A licence file (``LICENSE``, ``COPYING``,
...) states it for its directory, and a file without a statement of its own inherits from
the nearest directory above it that has one.

Only few lines are compared: the words of a template are ordered by weight, and a line
without any of the heaviest ones cannot reach the threshold once what remains of the vector
is shorter than it. These anchors are looked for first, in whole texts and then in lines;
no line that would match is left out. Ancestors are taken from distinct directories, so a
directory that holds a third of all files is one row until the last join, which adaptive
execution splits.

Words are runs of letters and digits in lower case. Null texts have no words; a file with a
null path states a licence but inherits none. Of licence files in one directory the best
match counts, then the first template and path. Rows that repeat a path are rows of their own;
rows that repeat an identifier share its statements, and one without it states nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.sources.workspace import stored

THRESHOLD = 0.7
LICENCE_FILES = ("LICENSE", "LICENCE", "COPYING", "NOTICE", "UNLICENSE")

# What statements of well-known licences say.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "Licensed under the Creative Commons Attribution license CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
}

_BREAK = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.split(F.lower(text), _BREAK)


def template_counts(templates: dict[str, str]) -> dict[str, dict[str, int]]:
    out: dict[str, dict[str, int]] = {}
    for name, text in templates.items():
        words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        out[name] = {w: words.count(w) for w in words}
    return out


def weights(templates: dict[str, str], files: int, having: dict[str, int]) -> tuple[dict[str, float], dict[str, dict[str, float]]]:
    """Inverse document frequencies of the templates' words, and unit template vectors."""
    counts = template_counts(templates)
    idf = {w: math.log((1 + files) / (1 + having.get(w, 0))) + 1 for own in counts.values() for w in own}
    vectors = {}
    for name, own in counts.items():
        raw = {w: n * idf[w] for w, n in own.items()}
        length = math.sqrt(sum(x * x for x in raw.values()))
        vectors[name] = {w: x / length for w, x in raw.items()}
    return idf, vectors


def anchors(vectors: dict[str, dict[str, float]], threshold: float) -> list[str]:
    """Words of which every line that reaches the threshold has one."""
    out = set()
    for own in vectors.values():
        left = sorted(own.items(), key=lambda x: (x[1], x[0]))
        rest = 0.0
        for word, weight in left:  # the lightest words may go while they stay too short
            rest += weight * weight
            if math.sqrt(rest) >= threshold - 1e-9:
                out.add(word)
    return sorted(out)


def stated(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(file, licence, similarity): the best statement of each file that has one. ``files``
    has columns file and text; repeated ``file`` values are one file."""
    templates = TEMPLATES if templates is None else templates
    spark = files.sparkSession
    vocabulary = sorted({w for own in template_counts(templates).values() for w in own})
    listed = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")
    found = files.select("file", "text", F.array_intersect(_words(F.col("text")), listed).alias("present"))
    having = {r.word: r.n for r in found.select(F.explode("present").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    idf, vectors = weights(templates, files.count(), having)
    needed = anchors(vectors, threshold)
    some = F.array(*map(F.lit, needed)) if needed else F.array().cast("array<string>")
    held = files.filter(F.arrays_overlap(_words(F.col("text")), some))
    lines = (held.select("file", F.posexplode(F.split("text", "\n")).alias("line", "body"))
             .select("file", "line", _words(F.col("body")).alias("words")).filter(F.arrays_overlap("words", some)))
    counted = (lines.select("file", "line", F.explode("words").alias("word")).filter(F.col("word").isin(vocabulary))
               .groupBy("file", "line", "word").agg(F.count("*").alias("n")))
    # A row for each word of each template: as many as the templates have words.
    entries = [F.struct(F.lit(w).alias("word"), F.lit(idf[w]).alias("idf"), F.lit(name).alias("licence"), F.lit(x).alias("weight"))
               for name, own in vectors.items() for w, x in own.items()]
    rows = F.array(*entries) if entries else F.array().cast("array<struct<word:string,idf:double,licence:string,weight:double>>")
    table = spark.range(1).select(F.inline(rows))
    pairs = counted.join(F.broadcast(table), "word").withColumn("value", F.col("n") * F.col("idf"))
    lengths = (counted.join(F.broadcast(table.select("word", "idf").distinct()), "word")
               .groupBy("file", "line").agg(F.sqrt(F.sum((F.col("n") * F.col("idf")) ** 2)).alias("length")))
    dots = pairs.groupBy("file", "line", "licence").agg(F.sum(F.col("value") * F.col("weight")).alias("dot"))
    similar = dots.join(lengths, ["file", "line"]).withColumn("similarity", F.round(F.col("dot") / F.col("length"), 9))
    best = F.min(F.struct((-F.col("similarity")).alias("down"), "licence")).alias("best")
    return (similar.filter(F.col("similarity") >= threshold).groupBy("file").agg(best)
            .select("file", "best.licence", (-F.col("best.down")).alias("similarity")))


def _directory(path: Column) -> Column:
    """What stands before the last slash; empty at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, file: str = "file",
         path: str = "path", text: str = "text") -> DataFrame:
    """One row per row of ``files``: file, path, licence, origin ('header', 'inherited' or
    null), similarity, and licence_dir, the directory it is inherited from."""
    own = files.select(F.col(file).alias("file"), F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    statements = stored(stated(own, templates, threshold), "licence-statements")
    places = own.select("file", "path", _directory(F.col("path")).alias("dir"))
    by_file = places.join(statements, "file", "left")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    named = by_file.filter(F.regexp_replace(name, r"\.(txt|md)$", "").isin(*LICENCE_FILES) & F.col("licence").isNotNull())
    first = F.min(F.struct((-F.col("similarity")).alias("down"), "licence", "path"))
    of_dir = stored(named.groupBy("dir").agg(first.alias("best")).select("dir", "best.licence", (-F.col("best.down")).alias("similarity")), "licence-directories")
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ancestors = (places.filter("dir IS NOT NULL").select("dir").distinct()
                 .select("dir", F.posexplode(F.array_distinct(above)).alias("depth", "above")))
    nearest = (ancestors.join(of_dir.withColumnRenamed("dir", "above"), "above").groupBy("dir")
               .agg(F.max(F.struct("depth", "above", "licence", "similarity")).alias("near")))
    out = by_file.join(nearest, "dir", "left")
    header = F.col("licence").isNotNull()
    return out.select("file", "path", F.coalesce("licence", "near.licence").alias("licence"),
                      F.when(header, F.lit("header")).when(F.col("near").isNotNull(), F.lit("inherited")).alias("origin"),
                      F.coalesce("similarity", "near.similarity").alias("similarity"),
                      F.when(~header, F.col("near.above")).alias("licence_dir"))


def document_path(doc_id: Column, source: Column) -> Column:
    """The place of a document in its source's tree: directories of ten thousand, thousand
    and hundred identifiers; every tenth file is the directory's licence file."""
    number = doc_id.cast("long")
    name = F.when(number % 10 == 0, F.lit("LICENSE")).otherwise(F.concat(F.lit("f"), number.cast("string"), F.lit(".txt")))
    level = lambda n: F.concat(F.lit("d"), F.floor(number / n).cast("string"))
    return F.concat_ws("/", F.coalesce(source, F.lit("none")), level(10_000), level(1_000), level(100), name)
