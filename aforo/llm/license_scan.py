"""Licences of files: TF-IDF cosine to templates, then inheritance from the nearest directory with a licence file.

Every line, every paragraph and the whole text of a file is a sparse TF-IDF vector, compared with the templates. Document
frequencies of the templates' terms are counted over the whole table. A file without a licence of its own takes that
of the nearest ancestor directory that holds a licence file, found by an equi-join on path prefixes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aforo.llm.common import Staging, give_back, id_and_text, tidied
from aforo.operators.joins import lookup_join

LEAST = 0.6
TERM = re.compile(rb"[a-z0-9][a-z0-9.+-]*[a-z0-9+]|[a-z0-9]")
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"
# What the header or notice of each licence says.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]


def terms(raw: bytes) -> list[bytes]:
    return TERM.findall(raw.lower())


class Templates:
    """Template vectors; ``rare`` are terms without one of which no text can reach the least cosine."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], documents: int, least: float):
        self.names, self.least = [n for n, _ in templates], least
        counts = [Counter(terms(t.encode())) for _, t in templates]
        self.number = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
        df = np.array([frequency.get(t, 0) for t in self.number], np.float64)
        self.idf = np.log((documents + 2) / (df + 1))
        # Of a term that no template has, only that it is none of theirs is known.
        self.other = float(np.log(documents + 2))
        self.vectors = np.zeros((len(counts), len(self.number)))
        for i, c in enumerate(counts):
            for term, n in c.items():
                self.vectors[i, self.number[term]] = n * self.idf[self.number[term]]
        self.vectors /= np.maximum(np.linalg.norm(self.vectors, axis=1, keepdims=True), 1e-12)
        # The cosine of a text that has only frequent terms is at most the norm of the template's part on them.
        part, common = np.zeros(len(counts)), set()
        for i in np.argsort(-df, kind="stable").tolist():
            part = part + self.vectors[:, i] ** 2
            if part.max() >= least**2:
                break
            common.add(i)
        self.rare = {t for t, i in self.number.items() if i not in common}

    def best(self, found: list[bytes]) -> tuple[float, str]:
        counts, values, norm = Counter(found), np.zeros(len(self.number)), 0.0
        for term, n in counts.items():
            at = self.number.get(term)
            if at is None:
                norm += (n * self.other) ** 2
            else:
                values[at] = n * self.idf[at]
        norm = np.sqrt(norm + (values**2).sum())
        cosines = self.vectors @ values / max(norm, 1e-12)
        best = int(cosines.argmax())
        return float(cosines[best]), self.names[best]

    def license_of(self, raw: bytes) -> tuple[float, str] | None:
        """The best (score, licence) of any line, paragraph or the whole text, ties by name."""
        best = None
        lines = [terms(line) for line in raw.split(b"\n")]
        candidates = [line for line in lines if not self.rare.isdisjoint(line)]
        if not candidates:
            return None
        for part in (*raw.split(b"\n\n"), raw):
            found = terms(part)
            if not self.rare.isdisjoint(found):
                candidates.append(found)
        for found in candidates:
            score, name = self.best(found)
            if score >= self.least and (best is None or (score, name) > best):
                best = score, name
        return best


@tidied
def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary: set[bytes]) -> Iterator[pa.RecordBatch]:
    counts, documents = Counter(), 0
    for batch in batches:
        for value in batch.column(1):
            documents += 1
            counts.update(vocabulary.intersection(terms(value.as_py() or b"")))
    counts[b""] = documents
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"]
    )


@tidied
def _scan(batches: Iterator[pa.RecordBatch], templates: Templates) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [templates.license_of(v.as_py() or b"") or (None, None) for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(2),
                batch.column(3),
                pa.array([name for _, name in found], pa.string()),
                pa.array([score for score, _ in found], pa.float64()),
            ],
            names=["__key", "path", "license", "score"],
        )
    give_back()


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    df: DataFrame, key: str = "doc_id", path: str = "path", text: str = "text", least: float = LEAST
) -> DataFrame:
    """Per row: the key, ``path``, ``license``, ``score`` and ``origin`` (own, inherited or NULL), ``directory`` it comes from.

    A licence file is one whose name is LICENSE, COPYING or NOTICE, with any ending. Of several in a directory the
    best score counts, then the greater name. A NULL path has no directory and inherits nothing; the root
    directory is the empty text. NULL and empty texts have no licence of their own. Each row
    has the licence of its own text, whether its key is NULL, repeated or neither. Other columns are not read.
    """
    stage, address = Staging(df.sparkSession, "licenses"), F.col(f"`{path}`")
    source = id_and_text(df, key, text, F.col(f"`{key}`").alias("__key"), address.cast("string").alias("path"))
    vocabulary = {t for _, body in TEMPLATES for t in terms(body.encode())}
    counts = source.mapInArrow(partial(_frequencies, vocabulary=vocabulary), "term binary, n long")
    # At most one row per term of the templates.
    frequency = {bytes(r.term): r.n for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    templates = Templates(TEMPLATES, frequency, frequency.pop(b"", 0), least)
    found = f"__key {source.schema['__key'].dataType.simpleString()}, path string, license string, score double"
    rows = stage.table(source.mapInArrow(partial(_scan, templates=templates), found), "own")
    rows = rows.withColumn("__dir", _directory(F.col("path")))
    name = F.regexp_extract("path", r"[^/]*$", 0)
    files = rows.where(F.col("license").isNotNull() & name.rlike(FILE_NAMES))
    roots = files.groupBy("__dir").agg(F.max(F.struct("score", "license")).alias("given"))
    roots = stage.table(roots.select(F.col("__dir").alias("root"), "given"), "roots")
    parts = F.split("__dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    places = rows.where("license IS NULL AND __dir IS NOT NULL").select("__dir").distinct()
    near = lookup_join(places.select("__dir", F.explode(ancestors).alias("up")), roots, [("up", "root")], "inner")
    nearest = near.groupBy("__dir").agg(F.max(F.struct(F.length("up").alias("n"), "up", "given")).alias("m"))
    nearest = nearest.select(F.col("__dir").alias("below"), F.col("m.up").alias("up"), F.col("m.given").alias("given"))
    out = lookup_join(rows, stage.table(nearest, "nearest"), [("__dir", "below")], "left")
    mine = F.col("license").isNotNull()
    return out.select(
        F.col("__key").alias(key),
        "path",
        F.coalesce("license", "given.license").alias("license"),
        F.coalesce("score", "given.score").alias("score"),
        F.when(mine, "own").when(F.col("given").isNotNull(), "inherited").alias("origin"),
        F.when(mine, F.col("__dir")).otherwise(F.col("up")).alias("directory"),
    )
