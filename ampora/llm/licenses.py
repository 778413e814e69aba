"""Licence scan: TF-IDF cosine of lines and texts to templates, and inheritance from directories.

A run of 1 to ``WINDOW`` consecutive lines that is near a notice (``HEADER``) is a licence header; the nearest
over all runs and notices is the file's own licence.  Lines without words don't count.  A text that is near a notice
or the text of a licence as a whole (``WHOLE``) has that licence.  An SPDX tag at a line's start goes before both, with
score 1: its expression, where ``-only``, ``-or-later`` and ``+`` of a single licence are left out as in the templates.
A file that is named like a licence file (``NAMES``) and has a licence is the licence file of its directory; no other
file speaks for its directory, however short it is.  A file without a licence of its own
inherits from the nearest directory above it, its own first, that has a licence file.

Inverse document frequencies of the templates' words are counted over all texts; a word of no template
weighs as much as one that occurs in no text, and no word weighs more than one of a text in ``RARE``, so
that a notice's cosine doesn't fall as the corpus grows.  For whole texts, term frequencies are damped (1 + log), for
else the commonest words of a long licence text would stand for it.  Runs are first bounded by sums over their lines and
only those that can be near are compared: a run's product with a notice is at most the sum of its lines' largest, and its
length at least the root of the sum of their squares.  Directories are joined, not files with files: every
directory's ancestors are looked up once, and files join their own directory.

Rows: null and empty texts have no header.  Null paths, and paths without a slash, are in the
top directory, ''.  Of several licence files in one directory the nearest to its template counts, then the first path.
Repeated rows are judged alike.  Further columns are kept; clashing names raise ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .words import slices, word_hashes

HEADER, WHOLE = 0.6, 0.75
WINDOW = 12              # worded lines of a run at most
RARE = 1000              # a word that fewer than one text in so many holds weighs no more
COMPARED = 1 << 20       # words of runs that are compared at once
NAMES = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([.\-][^/]*)?$"
SPDX = "SPDX-License-Identifier:"
_SPDX_ID = r"\(*[A-Za-z0-9][A-Za-z0-9.+\-]*\)*"
TAG = rf"(?m)^[^A-Za-z0-9\n]*(?:(?:rem|REM|dnl)\s+)?{SPDX}[ \t]*({_SPDX_ID}(?:[ \t]+(?:OR|AND|WITH|or|and|with)[ \t]+{_SPDX_ID})*)"
# Notices and short forms by which licences are declared; full texts are in license_texts.
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License "
        "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
_GNU_ONLY = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public License "
             "version {} as published by the Free Software Foundation.")
_GNU_SHORT = "{} under the GNU {} Public License, version {}."
_GNU_FAMILY = (("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.1", "Lesser General", "2.1"),
               ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"))
_CC = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
       ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file in the project root for details."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files, to deal in the Software without restriction"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
            "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in "
                   "compliance with the License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT OR Apache-2.0", "Licensed under either of Apache License, Version 2.0 or MIT license at your option."),
    *((k, _GNU_SHORT.format("This work is licensed" if name == "General" else "Licensed", name, v)) for k, name, v in _GNU_FAMILY),
    *((k, _GNU.format(name, v)) for k, name, v in _GNU_FAMILY),
    *((k, _GNU_ONLY.format(name, v)) for k, name, v in _GNU_FAMILY),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
                "http://www.boost.org/LICENSE_1_0.txt)"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                "which is available at https://www.eclipse.org/legal/epl-2.0/"),
    *((f"CC-{k}-4.0", f"Licensed under CC {k} 4.0.") for k, _ in _CC),
    *((f"CC-{k}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 International License.") for k, name in _CC),
    *((f"CC-{k}-4.0", f"Creative Commons {name} 4.0 International Public License") for k, name in _CC),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
                "work under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
OUT = ("license", "score", "how", "from_path")


def _hashed(texts: list[str]) -> list[np.ndarray]:
    parts = [word_hashes(data, ends) for data, ends in slices(pa.array(texts, pa.string()))]
    return [h[b[i]:b[i + 1]] for h, b in parts for i in range(len(b) - 1)]


def full_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text) of the whole licence texts; read by the driver, tasks get them with their function."""
    found = [f for f in resources.files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")]
    return tuple((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in sorted(found, key=lambda f: f.name))


class Templates:
    """Templates as sparse TF-IDF vectors over their own words; runs of lines are compared to the first ``notices``."""

    def __init__(self, texts: list[str], notices: int, texts_with: dict[int, int] | None = None, n: int = 0) -> None:
        words = _hashed(texts)
        self.words = np.unique(np.concatenate(words)) if words else np.empty(0, np.uint64)
        with_word = np.array([(texts_with or {}).get(k, 0) for k in range(len(self.words))], float)
        self.idf = np.log(np.minimum((1 + n) / (1 + with_word), RARE)) + 1
        self.other = np.log(min(1 + n, RARE)) + 1
        tf = np.zeros((len(texts), len(self.words)))
        for k, w in enumerate(words):
            np.add.at(tf[k], np.searchsorted(self.words, w), 1)
        self.notices = self._unit(tf[:notices])
        self.wholes = self._unit(np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0))

    def _unit(self, tf: np.ndarray) -> np.ndarray:
        weight = tf * self.idf
        return weight / np.maximum(np.linalg.norm(weight, axis=1, keepdims=True), 1e-12)

    def number(self, words: np.ndarray) -> np.ndarray:
        """Each word's number, or -1."""
        if not len(self.words):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def products(self, words: np.ndarray, bounds: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(template, largest product with a template's unit vector, own length) of each text; 0 for texts that share no word."""
        n = len(bounds) - 1
        best, top = np.zeros(n, np.int64), np.zeros(n)
        if not len(words) or not len(self.words):
            return best, top, np.zeros(n)
        of = np.repeat(np.arange(n), np.diff(bounds))
        order = np.lexsort((words, of))
        of, words = of[order], words[order]
        first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (words[1:] != words[:-1])]))
        tf = np.diff(np.append(first, len(of))).astype(float)
        of, term = of[first], self.number(words[first])
        weight = (1 + np.log(tf) if whole else tf) * np.where(term >= 0, self.idf[term], self.other)
        length = np.sqrt(np.bincount(of, weight * weight, n))
        shared = term >= 0
        of, term, weight = of[shared], term[shared], weight[shared]
        for k, row in enumerate(self.wholes if whole else self.notices):
            product = np.bincount(of, weight * row[term], n)
            more = product > top
            best[more], top[more] = k, product[more]
        return best, top, length

    def nearest(self, words: np.ndarray, bounds: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """(template, cosine) of each text; cosine 0 for texts that share no word with any."""
        best, top, length = self.products(words, bounds, whole)
        return best, top / np.maximum(length, 1e-12)

    def nearest_run(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(notice, cosine) of each text's run of lines that is nearest to one; cosine 0 if none is near (``HEADER``)."""
        line_ends = _line_bounds(data, ends)
        words, bounds = word_hashes(data, line_ends)
        worded = np.flatnonzero(np.diff(bounds))
        bounds = np.append(bounds[worded], len(words))          # lines between hold no words
        doc = np.searchsorted(ends, line_ends[worded], "left")  # the first text that ends at or after the line
        notice, cosine = np.zeros(len(ends), np.int64), np.zeros(len(ends))
        _, top, length = self.products(words, bounds, whole=False)
        product, square = (np.concatenate([[0], np.cumsum(x)]) for x in (top, length * length))
        for k in range(1, min(WINDOW, len(doc)) + 1):
            at = np.arange(len(doc) - k + 1)
            most = (product[k:] - product[:-k]) / np.sqrt(np.maximum(square[k:] - square[:-k], 1e-12))
            # runs of one text that can be near, and nearer than what was found
            least = np.clip(cosine[doc[at]] + 1e-9, HEADER - 1e-6, None)
            at = at[(doc[at] == doc[at + k - 1]) & (most >= least) & (least < 1)]
            size = bounds[at + k] - bounds[at]
            chunk = np.cumsum(size) // COMPARED
            for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(chunk)) + 1) if len(at) else ():
                to = np.concatenate([[0], np.cumsum(size[part])])
                held = np.repeat(bounds[at[part]] - to[:-1], size[part]) + np.arange(to[-1])
                found, near = self.nearest(words[held], to, whole=False)
                here = doc[at[part]]
                order = np.lexsort((np.arange(len(here)), -near, here))
                lead = order[np.concatenate([[True], here[order][1:] != here[order][:-1]])]
                lead = lead[near[lead] > np.maximum(cosine[here[lead]], HEADER - 1e-12)]
                notice[here[lead]], cosine[here[lead]] = found[lead], near[lead]
        return notice, cosine


def _line_bounds(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ends of all lines of all texts of a slice; a text's end ends a line."""
    return np.unique(np.concatenate([np.flatnonzero(data == 0x0A) + 1, ends]))


def _terms(text: Column, texts: list[str]) -> Column:
    def terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Templates(texts, 0)
        for batch in batches:
            out: list[list[int]] = []
            for data, ends in slices(batch):
                words, bounds = word_hashes(data, ends)
                number = known.number(words)
                out += [np.unique(x[x >= 0]).tolist() for x in np.split(number, bounds[1:-1])]
            yield pa.array(out, pa.list_(pa.int32()))

    return F.arrow_udf(terms, "array<int>")(text)


def _judged(text: Column, texts: list[str], notices: int, texts_with: dict[int, int], n: int) -> Column:
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Templates(texts, notices, texts_with, n)
        for batch in batches:
            parts = []
            for data, ends in slices(batch):
                whole = known.nearest(*word_hashes(data, ends), whole=True)
                parts.append(np.stack([*known.nearest_run(data, ends), *whole]))
            t, c, wt, wc = np.concatenate([np.empty((4, 0)), *parts], axis=1)
            yield pa.StructArray.from_arrays([pa.array(t.astype(np.int32)), pa.array(c), pa.array(wt.astype(np.int32)), pa.array(wc)],
                                             ["template", "cosine", "whole_template", "whole_cosine"])

    return F.arrow_udf(judge, "struct<template:int,cosine:double,whole_template:int,whole_cosine:double>")(text)


def directory(path: Column) -> Column:
    """A path without its last part; '' for the top."""
    return F.coalesce(F.regexp_replace(F.when(F.contains(path, F.lit("/")), path).otherwise(F.lit("")), r"/[^/]*$", ""), F.lit(""))


def url_path(url: Column) -> Column:
    """Lower-cased host and the path of a URL as a file path; null without ``://``.  Query and fragment are left out."""
    rest = F.regexp_extract(url, r"^[^/?#]*://([^/?#]*)([^?#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(F.lower(rest), F.regexp_extract(url, r"^[^/?#]*://([^/?#]*)([^?#]*)", 2)))


def page_text(html: Column) -> Column:
    """A page's text, a line per run between tags."""
    return F.regexp_replace(html, r"<[^>]*>", "\n")


def spdx_tag(text: Column) -> Column:
    """The expression of a text's first SPDX tag, or null; a single licence without its ``-only``, ``-or-later`` or ``+``."""
    tag = F.regexp_replace(F.regexp_extract(text, TAG, 1), r"[.\-]+$", "")
    plain = F.regexp_replace(tag, r"[()]", "")
    tag = F.when(~plain.rlike(r"\s"), F.regexp_replace(plain, r"(-only|-or-later|\+)$", "")).otherwise(tag)
    # most texts hold no tag: a plain search goes before the pattern
    return F.when(F.contains(text, F.lit(SPDX)) & ~tag.isin("", "NONE", "NOASSERTION"), tag)


def license_scan(files: DataFrame, path: str = "path", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES,
                 full: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """``files`` without their text, with license, score, how (header, file, inherited or none) and from_path.

    ``templates`` are notices, compared to runs of lines and to whole texts; ``full`` are licence texts, compared
    to whole texts only (by default those of ``license_texts``).
    """
    clash = {c.lower() for c in files.columns} & {*OUT, "dir_of_file", "judged_file", "tag_of_file"}
    if clash:
        raise ValueError(f"output columns already exist: {sorted(clash)}")
    known = (*templates, *(full_texts() if full is None else full))
    names, texts = [t[0] for t in known], [t[1] for t in known]
    terms = files.select(_terms(F.col(text), texts).alias("terms"))
    # at most one row per word of the templates, and one for the number of texts
    counts = {r["term"]: r["n"] for r in terms.select(F.explode(F.concat("terms", F.array(F.lit(-1)))).alias("term"))
              .groupBy("term").agg(F.count("*").alias("n")).collect()}
    n = counts.pop(-1, 0)
    judged = files.withColumns({
        "judged_file": _judged(F.col(text), texts, len(templates), counts, n), "tag_of_file": spdx_tag(F.col(text)),
        "dir_of_file": directory(F.col(path))}).drop(text)
    label = F.array(*(F.lit(x) for x in names))
    j, tag = F.col("judged_file"), F.col("tag_of_file")
    whole, header = j["whole_cosine"] >= WHOLE, j["cosine"] >= HEADER
    named = F.coalesce(F.col(path).rlike(NAMES), F.lit(False))
    any_of = tag.isNotNull() | whole | header
    own = judged.withColumns({
        "license": F.when(tag.isNotNull(), tag)
                    .when(whole & ((j["whole_cosine"] >= j["cosine"]) | (j["whole_template"] >= len(templates))), F.get(label, j["whole_template"]))
                    .when(header, F.get(label, j["template"])),
        "score": F.when(tag.isNotNull(), F.lit(1.0))
                  .when(whole | header, F.round(F.greatest(j["whole_cosine"], j["cosine"]), 6)),
        "how": F.when(any_of & named, "file").when(any_of, "header")}).drop("judged_file", "tag_of_file")
    # judged once, however many joins read it
    spark = files.sparkSession
    place = scratch_path(spark, "licences-judged")
    own.write.parquet(place)
    own = spark.read.schema(own.schema).parquet(place)
    of_directory = own.where("how = 'file'").groupBy("dir_of_file").agg(
        F.min(F.struct((-F.col("score")).alias("order"), F.col(path).alias("from"), "license")).alias("given"))
    parts = F.split("dir_of_file", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("ancestor")))
    upward = own.select("dir_of_file").distinct().select("dir_of_file", F.inline(above))
    nearest = (upward.join(of_directory.select(F.col("dir_of_file").alias("ancestor"), "given"), "ancestor")
               .groupBy("dir_of_file").agg(F.max(F.struct("depth", "given"))["given"].alias("given")))
    found = own.join(nearest, "dir_of_file", "left")
    mine = F.col("license").isNotNull()
    return found.select(
        *[c for c in files.columns if c != text],
        F.coalesce("license", F.col("given.license")).alias("license"),
        F.coalesce("score", -F.col("given.order")).alias("score"),
        F.coalesce("how", F.when(F.col("given").isNotNull(), "inherited"), F.lit("none")).alias("how"),
        F.when(mine, F.col(path)).otherwise(F.col("given.from")).alias("from_path"))
