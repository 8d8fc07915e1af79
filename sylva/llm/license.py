"""Licence scan: notices by sparse TF-IDF cosine to templates, then inheritance along paths.

Every line of a file is a bag of words, and so is every window of as many words as a template has,
across line breaks, in a file of any length. TF-IDF cosines to the templates are computed over an
inverted index of the templates' words; lines and windows that share no telling word are not scored.
Windows slide around the telling words of their template only, so the work is linear in the text. The
best line or window over ``HEADER_COSINE`` is the file's own notice; its line is the one it begins in. A
file without any is scored as a whole. A file whose
words are for the most part notice lines, or whose name says so, is a licence file and governs its
directory. A file without a notice of its own inherits from the licence file of the nearest directory
above it: its ancestor directories are joined with the governed ones by path.

Words outside the templates count in a bag's length with the weight of a word in no template, words of
everyday language with a small one; a notice shares at least ``OWN_WORDS`` other words with its template. NULL
texts and paths have no notice and no directory; a NULL path inherits nothing. Empty texts have no notice,
very long ones are scanned whole; an empty table gives an empty one. Several licence
files in one directory: the best cosine governs, then the name that sorts first. Repeated rows are
judged alike. Extra columns are kept by ``scan`` (those with the names it adds give way)."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable
from operator import mul

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, map_texts, read, small, stored

HEADER_COSINE = 0.6
#: Least number of a template's words, but those of everyday language, that a notice has.
OWN_WORDS = 2
#: A licence file has at least this share of its words in notice lines.
FILE_SHARE = 0.25
LICENSE_NAME = r"(?i)(^|/)(licen[cs]e|copying)[^/]*$"
#: Notices and licence texts by SPDX identifier, as their publishers word them.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License", "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "ISC": [
        "Released under the ISC License", "Licensed under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies"],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or any later version"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or any later version"],
    "LGPL-2.1": [
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or any later version"],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or any later version"],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or any later version"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "Licensed under the Simplified BSD License"],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission"],
    "MPL-2.0": ["Licensed under the Mozilla Public License 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain", "Released under the Unlicense"],
    "CC0-1.0": ["Licensed under CC0 1.0", "CC0 1.0 Universal Public Domain Dedication"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-SA-4.0": [
        "Licensed under CC BY-NC-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": [
        "Licensed under CC BY-NC-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "proprietary": ["All rights reserved", "Copyright. All rights reserved", "Proprietary and confidential. All rights reserved"],
}
# the short form that source files carry, of every licence that has an identifier
for _name, _texts in TEMPLATES.items():
    if _name != "proprietary":
        _texts.append(f"SPDX-License-Identifier: {_name}")
_WORD = re.compile(r"[^\W_]+")
#: Words of everyday language, the commonest first; the last choice for an anchor, from the end. In a bag
#: they weigh no more than this.
EVERYDAY_IDF = 0.3
EVERYDAY = ("the of and to a in that is was it for with as be on not this are or by at from have you which but all they an were "
            "if has their one can more will no your its any may other such these under").split()


class TemplateIndex:
    """Inverted index of the templates' words with TF-IDF weights of unit length."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES):
        bags = [(name, _WORD.findall(t.lower())) for name, texts in sorted(templates.items()) for t in texts]
        self.names = [name for name, _ in bags]
        holders: dict[str, set[int]] = {}
        for i, (_, bag) in enumerate(bags):
            for w in bag:
                holders.setdefault(w, set()).add(i)
        n = len(bags)
        # templates are no sample of a language: words of everyday language weigh little, however few templates have them
        self.idf = {w: math.log((1 + n) / (1 + len(s))) + 1 for w, s in holders.items()} | dict.fromkeys(EVERYDAY, EVERYDAY_IDF)
        self.other = math.log(1 + n) + 1
        self.lists: dict[str, list[tuple[int, float]]] = {}
        for i, (_, bag) in enumerate(bags):
            weights = {w: bag.count(w) * self.idf[w] for w in bag}
            length = math.sqrt(sum(x * x for x in weights.values()))
            for w, x in weights.items():
                self.lists.setdefault(w, []).append((i, x / length))
        # every template has one of its telling words: a line without any is close to none
        telling = {max(bag, key=lambda w: (self.idf[w], w)) for _, bag in bags} | {w for w in holders if len(w) > 3}
        self.telling = re.compile("|".join(sorted(map(re.escape, telling), key=len, reverse=True)))
        self.sizes = [len(bag) for _, bag in bags]
        self.weights = [{w: y for w, found in self.lists.items() for j, y in found if j == i} for i in range(n)]
        # beside the cosine, a notice shares at least two words that are not everyday language with its template: a
        # foreign word that is spelt like a licence ("mit"), said often, is close to a short template too
        self.own_words = [frozenset(w) - frozenset(EVERYDAY) for w in self.weights]
        # words of each template without which the others' share of its length keeps the cosine of any bag below
        # the limit, words of everyday language last (any choice is exact, a rare word meets fewer texts)
        self.anchors: dict[str, list[int]] = {}
        for i, weights in enumerate(self.weights):
            left = 1.0
            for w in sorted(weights, key=lambda w: (-EVERYDAY.index(w) if w in EVERYDAY else -math.inf, -weights[w], -len(w), w)):
                if left < HEADER_COSINE ** 2:
                    break
                left -= weights[w] ** 2
                self.anchors.setdefault(w, []).append(i)
        self.anchor_words = frozenset(self.anchors)

    def in_reach(self, words: set[str], templates: Iterable[int] | None = None, least: float = HEADER_COSINE) -> list[int]:
        """The templates that a bag of some of these words can reach ``least`` with: they have an anchor among
        them, and the cosine is no more than the length of what a template shares with them."""
        if templates is None:
            templates = {i for w in self.anchor_words.intersection(words) for i in self.anchors[w]}
        return [i for i in templates if len(self.own_words[i] & words) >= OWN_WORDS and sum([x * x for w, x in self.weights[i].items() if w in words]) >= least ** 2 - 1e-9]

    def best(self, line: str) -> tuple[str | None, float]:
        """The licence of the closest template and the cosine; ties go to the name that sorts first."""
        low = line.lower()
        if not self.telling.search(low):
            return None, 0.0
        counts = Counter(_WORD.findall(low))
        known = sorted(self.idf.keys() & counts.keys())
        others = sum(map(mul, counts.values(), counts.values())) - sum([counts[w] ** 2 for w in known])
        square, scores, shared = others * self.other ** 2, {}, Counter()
        for w in known:
            x = counts[w] * self.idf[w]
            square += x * x
            for i, y in self.lists.get(w, ()):
                scores[i] = scores.get(i, 0.0) + x * y
                shared[i] += w in self.own_words[i]
        scores = {i: x for i, x in scores.items() if shared[i] >= OWN_WORDS}
        if not scores:
            return None, 0.0
        i = max(scores, key=lambda i: (round(scores[i], 12), -i))
        return self.names[i], min(1.0, scores[i] / math.sqrt(square))

    def windows(self, words: list[str], least: float = HEADER_COSINE, hits: Iterable[int] | None = None) -> list[tuple[int, int, str, float]]:
        """(first word, end, licence, cosine) of the windows of ``words`` that reach ``least``: per template
        and run of overlapping windows the best one, the first of equals. ``hits`` are the places of anchors."""
        near: dict[int, list[int]] = {}
        alive = set(self.in_reach(set(words), None, least))
        for k in range(len(words)) if hits is None else hits:
            for i in self.anchors.get(words[k], ()):
                if i in alive:
                    near.setdefault(i, []).append(k)
        out = []
        for i, met in sorted(near.items()):
            size, weights, own = min(self.sizes[i], len(words)), self.weights[i], self.own_words[i]
            # runs of anchors whose windows overlap; one whose words cannot reach the limit is left out
            anchors, run = [], []
            for a in [*met, None]:
                if run and (a is None or a - run[-1] >= 2 * size):
                    if self.in_reach(set(words[max(run[0] - size + 1, 0): run[-1] + size]), (i,), least):
                        anchors += run
                    run = []
                if a is not None:
                    run.append(a)
            counts: dict[str, int] = {}
            begin = end = shared = 0
            square = dot = 0.0
            best: tuple[int, int, str, float] | None = None
            last = -1  # the last start that was scored
            for a in anchors:
                first, stop = max(a - size + 1, last + 1, 0), min(a, len(words) - size)
                if first > stop:
                    continue
                if first >= end or first < begin:  # nothing in common with the window before
                    counts, begin, end, shared, square, dot = {}, first, first, 0, 0.0, 0.0
                for start in range(first, stop + 1):
                    while end < start + size:
                        w = words[end]
                        c, x = counts.get(w, 0), self.idf.get(w, self.other)
                        shared += not c and w in own
                        counts[w], square, dot, end = c + 1, square + (2 * c + 1) * x * x, dot + x * weights.get(w, 0.0), end + 1
                    while begin < start:
                        w = words[begin]
                        c, x = counts[w], self.idf.get(w, self.other)
                        shared -= c == 1 and w in own
                        counts[w], square, dot, begin = c - 1, square - (2 * c - 1) * x * x, dot - x * weights.get(w, 0.0), begin + 1
                    cosine = min(1.0, dot / math.sqrt(square)) if square > 1e-9 else 0.0
                    if cosine >= least and shared >= OWN_WORDS:
                        if best is not None and start >= best[1]:
                            out.append(best)
                            best = None
                        if best is None or cosine > best[3] + 1e-12:
                            best = (start, start + size, self.names[i], cosine)
                last = stop
            if best is not None:
                out.append(best)
        return out


def own_notice(text: str | None, index: TemplateIndex, least: float = HEADER_COSINE) -> tuple[str | None, float, int | None, float]:
    """(licence, cosine, number of the line, share of words in notice lines) of one text."""
    low = (text or "").lower()
    words = _WORD.findall(low)
    alive = index.in_reach(set(words), None, least)
    if not alive:  # no line, window or whole of the text can be close to a template
        return None, 0.0, None, 0.0
    found, cosine, at = None, 0.0, None
    spans = [m.start() for m in _WORD.finditer(low)]
    breaks = [m.start() for m in re.finditer("\n", low)]
    lines = text.split("\n")
    total = sum(len(line.split()) for line in lines)
    noticed = set()
    hits = [j for j, w in enumerate(words) if w in index.anchor_words]
    for k in sorted({bisect_right(breaks, spans[j]) for j in hits}):
        if not index.in_reach(set(_WORD.findall(lines[k].lower())), alive, least):
            continue
        name, c = index.best(lines[k])
        if name is not None and c >= least:
            noticed.add(k)
            if c > cosine:
                found, cosine, at = name, c, k
    share = sum(len(lines[k].split()) for k in noticed)
    # a notice inside a line or broken over lines
    windows = sorted(index.windows(words, least, hits), key=lambda w: (-round(w[3], 12), w[2], w[0]))
    spoken: set[int] = set()
    for begin, end, name, c in windows:
        if c > cosine + 1e-12:
            found, cosine, at = name, c, bisect_right(breaks, spans[begin])
        spoken.update(range(begin, end))
    share += sum(bisect_right(breaks, spans[n]) not in noticed for n in spoken)  # outside lines that are notices as a whole
    if found is None and total:  # a notice with other words between its own
        name, c = index.best(text)
        if name is not None and c >= least:
            found, cosine, at, share = name, c, 0, total
    return found, cosine, at, min(1.0, share / total) if total else 0.0


def directory(path: Column) -> Column:
    """Path without its last part; a path of one part is in the directory ''."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """``files`` (path, text and any more) with license, how ('own', 'inherited' or 'none'), cosine,
    license_line and from_dir (the directory inherited from)."""
    index = TemplateIndex(templates)

    def noticed(texts: list[str | None]) -> dict:
        got = [own_notice(t, index) for t in texts]
        return {"license": [g[0] for g in got], "cosine": [g[1] for g in got], "license_line": [g[2] for g in got], "notice_share": [g[3] for g in got]}

    added = {"license": "string", "cosine": "double", "license_line": "int", "notice_share": "double"}
    row = fresh("_file", files.columns)
    own = map_texts(files, added, noticed).drop("text").withColumn(row, F.monotonically_increasing_id())
    own = stored(own.drop("how", "from_dir"), "licenses")
    speaks = (F.col("notice_share") >= FILE_SHARE) | F.col("path").rlike(LICENSE_NAME)
    by_rank = F.min(F.struct((-F.col("cosine")).alias("c"), "license", "path"))
    governed = own.where("license IS NOT NULL AND path IS NOT NULL").where(speaks).groupBy(directory(F.col("path")).alias("_dir")) \
        .agg(by_rank.alias("_by"))
    governed = stored(governed.select("_dir", F.col("_by.license").alias("_given"), (-F.col("_by.c")).alias("_cosine")), "governed")
    # ancestors of each directory that holds a file without notice, not of each file
    needy = own.where("license IS NULL AND path IS NOT NULL").select(directory(F.col("path")).alias("_of")).distinct()
    parts = F.when(F.col("_of") == "", F.array().cast("array<string>")).otherwise(F.split("_of", "/"))
    above = needy.select("_of", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("dir")))).alias("up"))
    met = above.join(governed, F.col("up.dir") == F.col("_dir"))
    nearest = met.groupBy("_of").agg(F.max(F.struct("up.depth", "_dir", "_given", "_cosine")).alias("_near"))
    nearest = stored(nearest, "inherited")
    here, of, near = (fresh(c, [*own.columns, "how", "from_dir"]) for c in ("_here", "_of", "_near"))
    nearest = nearest.select(F.col("_of").alias(of), F.col("_near").alias(near))
    needing = own.withColumn(here, F.when(F.col("license").isNull(), directory(F.col("path"))))
    out = needing.join(small(nearest, nearest.count()), F.col(here) == F.col(of), "left")
    how = F.when(F.col("license").isNotNull(), "own").when(F.col(near).isNotNull(), "inherited").otherwise("none")
    out = out.withColumn("how", how).withColumn("from_dir", F.col(f"{near}._dir")) \
        .withColumn("cosine", F.when(F.col("license").isNotNull(), F.col("cosine")).otherwise(F.coalesce(f"{near}._cosine", F.lit(0.0)))) \
        .withColumn("license", F.coalesce("license", f"{near}._given"))
    return out.drop(here, of, near, row)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of a tree: their source, then two levels of directories by id."""
    docs = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.floor(F.col("doc_id") / 10000), F.floor(F.col("doc_id") / 100),
                       F.col("doc_id"))
    return scan(docs.select("doc_id", path.alias("path"), "text"))
