"""Operator 9, license scans: Dice coefficient over word bigrams against licence templates.

Each line of a text, and the text as a whole, is normalised (lower case, other
characters than letters and digits as spaces) and turned into its set of word bigrams.
A template of b bigrams can only reach a coefficient t with sets of
b t / (2 - t) to b (2 - t) / t bigrams, so other sizes are not compared.  The templates'
bigrams are a fixed small table; only bigrams found in it are counted further.

A notice can also be wrapped over lines of a longer text or stand inside a long line.
So runs of consecutive bigrams (over line ends) within a template's size bounds are
scored too, unless they touch a line that matches (or the whole text does).  A run that
reaches the threshold is a match; of runs that overlap, the best counts in n_matches.

Defined results: a null or empty text, or one without a match, has no licence
(null) and 0 matches; on equal coefficients the licence id decides; repeated
rows each get their row, with the same score; a text of any length is looked at whole, in lines and blocks of bigrams; an
empty table gives an empty result; other columns are ignored, also those whose names differ in case only.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import only

THRESHOLD = 0.8
#: First bigrams of runs in a block of a text.
BLOCK = 64
#: Words of running text: a template is told by its others where they are enough.
COMMON = frozenset("a all and as at by for from in is it of on or that the this to under was with you".split())
# fixed values: (licence id, template): notices as they stand in sources and on pages, and paragraphs of licence texts
TEMPLATES = [
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-2-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("reserved", "All rights reserved."),
]


def template_bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).strip().split(" ")
    return sorted({f"{a} {b}" for a, b in zip(words[:-1], words[1:], strict=True)})


def size_bounds(b: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """The least and largest number of bigrams of a set whose coefficient with b bigrams can reach the threshold."""
    fits = [n for n in range(1, 4 * b + 1) if 2 * min(n, b) >= threshold * (n + b)]
    return fits[0], fits[-1]


def signal_words(bigrams: list[str], threshold: float = THRESHOLD) -> set[str]:
    """Words without which no set of bigrams reaches the threshold: a match has at least `low` of the b bigrams, so one of any b - low + 1."""
    need = len(bigrams) - size_bounds(len(bigrams), threshold)[0] + 1
    words = sorted({w for g in bigrams for w in g.split(" ")}, key=lambda w: (w in COMMON, -len(w), w))
    found: set[str] = set()
    while sum(any(w in found for w in g.split(" ")) for g in bigrams) < need:
        found.add(words[len(found)])  # words that running text has seldom come first
    return found


def _bigrams(words: Column) -> Column:
    n = F.size(words)
    return F.when(n >= 2, F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))))


def _passages(told: DataFrame, known: list[tuple[int, str, list[str]]], threshold: float) -> DataFrame:
    """Runs of words that match a template: (doc_id, th, lines, t, id, a, e, first, last, score), bigrams a to e in lines first to last of `lines`.

    `told` has (doc_id, th, clean).  The best run from each first bigram is given; a best run starts with a bigram of its template.
    """
    longest = max(size_bounds(len(b), threshold)[1] for _, _, b in known)
    signal = sorted({g for _, _, b in known for g in b if set(g.split(" ")) & signal_words(b, threshold)})
    text = F.trim(F.regexp_replace("clean", "[ \n]+", " "))
    near = told.where(text.rlike(f"(?<![a-z0-9])(?:{'|'.join(signal)})(?![a-z0-9])"))
    in_line = lambda line, i: F.transform(F.filter(F.split(line, " "), lambda w: w != ""), lambda w: F.struct(w.alias("w"), i.alias("i")))
    words = near.select("doc_id", "th", F.split("clean", "\n").alias("rows")).select("doc_id", "th", F.size("rows").alias("lines"), F.flatten(F.transform("rows", in_line)).alias("words"))
    pair = lambda a, b: F.struct(F.concat(a["w"], F.lit(" "), b["w"]).alias("g"), a["i"].alias("first"), b["i"].alias("last"))
    n = F.size("words")
    pairs = words.where(n >= 2).select("doc_id", "th", "lines", F.zip_with(F.slice("words", F.lit(1), n - 1), F.slice("words", F.lit(2), n - 1), pair).alias("pairs"))
    # blocks of so many first bigrams, with what runs from them can reach
    at = F.sequence(F.lit(0), F.floor((F.size("pairs") - 1) / BLOCK).cast("int"))
    cut = pairs.select("doc_id", "th", "lines", F.explode(F.transform(at, lambda k: F.struct((k * BLOCK).alias("base"), F.slice("pairs", k * BLOCK + 1, BLOCK + longest - 1).alias("p")))).alias("block")).select("doc_id", "th", "lines", "block.*")
    block = cut.select("*", F.col("p.g").alias("gs")).where(F.arrays_overlap("gs", F.array(*[F.lit(g) for g in signal])))
    # fixed size: the templates are a parameter, not data
    table = [{"t": i, "id": name, "low": (x := size_bounds(len(b), threshold))[0], "high": x[1], "tg": b} for i, name, b in known]
    tpl = told.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(table)), "array<struct<t:int,id:string,low:int,high:int,tg:array<string>>>")).alias("r")).select("r.*")
    met = block.crossJoin(F.broadcast(tpl)).where(F.size(F.array_intersect("gs", "tg")) >= F.col("low"))
    starts = F.filter(F.sequence(F.lit(1), F.least(F.size("gs"), F.lit(BLOCK))), lambda i: F.array_contains(F.col("tg"), F.element_at("gs", i)))
    begun = met.select("*", F.explode(starts).alias("i")).withColumn("run", F.slice("gs", F.col("i"), F.col("high")))
    begun = begun.where((F.size("run") >= F.col("low")) & (F.size(F.array_intersect("run", "tg")) >= F.col("low")))
    ends = begun.select("*", F.explode(F.sequence("low", F.size("run"))).alias("k")).withColumn("part", F.slice("run", F.lit(1), F.col("k")))
    own, common, b = F.size(F.array_distinct("part")), F.size(F.array_intersect("part", "tg")), F.size("tg")
    hit = ends.where(2 * common >= threshold * (own + b)).withColumn("score", F.round(2 * common / (own + b), 6))
    a = F.col("base") + F.col("i")
    found = hit.select("doc_id", "th", "lines", "t", "id", a.alias("a"), (a + F.col("k") - 1).alias("e"), F.element_at("p", F.col("i"))["first"].alias("first"), F.element_at("p", F.col("i") + F.col("k") - 1)["last"].alias("last"), "score")
    best = F.min(F.struct((-F.col("score")).alias("s"), "e", "id", "lines", "first", "last")).alias("m")
    return found.groupBy("doc_id", "th", "t", "a").agg(best).select("doc_id", "th", "m.lines", "t", "m.id", "a", "m.e", "m.first", "m.last", (-F.col("m.s")).alias("score"))


def _new_passages(runs: DataFrame, scored: DataFrame, longest: int) -> DataFrame:
    """The runs that touch no matching segment; `counts` marks those that no better one overlaps."""
    seen = scored.groupBy(F.col("doc_id").alias("s_id"), F.col("th").alias("s_th")).agg(F.collect_set("segment").alias("seen"))
    both = runs.join(seen, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("th") == F.col("s_th")), "left")
    # the segment numbered `lines` is the whole text
    new = both.where(~F.coalesce(F.exists("seen", lambda s: (s == F.col("lines")) | s.between(F.col("first"), F.col("last"))), F.lit(False)))
    rank = F.struct((-F.col("score")).alias("s"), "a", "e", "t")
    reach = Window.partitionBy("doc_id", "th").orderBy("a").rangeBetween(-longest - 1, longest + 1)
    new = new.withColumn("rank", rank).withColumn("others", F.collect_list("rank").over(reach))
    # bigrams e and e + 1 have a word in common
    return new.withColumn("counts", ~F.exists("others", lambda o: (o < F.col("rank")) & (o["a"] <= F.col("e") + 1) & (o["e"] + 1 >= F.col("a"))))


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, license (the best match), score, n_matches (segments and other passages that match a template), licenses (all ids, sorted)."""
    spark = docs.sparkSession
    known = [(i, name, template_bigrams(text)) for i, (name, text) in enumerate(templates or TEMPLATES)]
    bounds = {i: size_bounds(len(b), threshold) for i, _, b in known}
    # fixed size: the templates are a parameter of this function, not data
    table = [{"t": i, "id": name, "b": len(b), "low": bounds[i][0], "high": bounds[i][1], "g": g} for i, name, b in known for g in b]
    grams = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(table)), "array<struct<t:int,id:string,b:int,low:int,high:int,g:string>>")).alias("r")).select("r.*")
    rows = only(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("th"), "text")
    signals = sorted({w for _, _, b in known for w in signal_words(b, threshold)})
    signal = f"(?<![a-z0-9])(?:{'|'.join(signals)})(?![a-z0-9])"
    clean = F.regexp_replace(F.translate("low", "\r", " "), "[^a-z0-9\n]+", " ")
    lines = F.split(clean, "\n")
    whole = F.when(F.size(lines) > 1, F.array(F.replace(clean, F.lit("\n"), F.lit(" ")))).otherwise(F.array().cast("array<string>"))
    least, most = min(x for x, _ in bounds.values()), max(y for _, y in bounds.values())
    # only texts and segments with a signal word of some template are looked at closer;
    # a segment of n distinct bigrams has more than n words; long segments may repeat theirs, so only a lower bound is known before
    # rows equal in doc_id and text are looked at once, so no copy adds to another's counts; few rows have a signal word, so few are dealt
    told = rows.where("text is not null").select("doc_id", "th", F.lower("text").alias("low")).where(F.col("low").rlike(signal)).dropDuplicates(["doc_id", "th"])
    runs = _passages(told.select("doc_id", "th", clean.alias("clean")), known, threshold)
    segment = told.select("doc_id", "th", F.posexplode(F.concat(lines, whole)).alias("segment", "line")).where(F.col("line").rlike(signal))
    words = F.split(F.trim(F.regexp_replace("line", " +", " ")), " ")
    first = segment.where(F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) >= least - 1).select("doc_id", "th", "segment", words.alias("words"))
    sets = first.where(F.size("words") > least).select("doc_id", "th", "segment", _bigrams(F.col("words")).alias("grams"))
    sets = sets.where(F.size("grams").between(least, most)).select("doc_id", "th", "segment", F.size("grams").alias("n"), F.explode("grams").alias("g"))
    met = sets.join(F.broadcast(grams), "g").where("n between low and high")
    scored = met.groupBy("doc_id", "th", "segment", "t", "id", "n", "b").agg(F.count(F.lit(1)).alias("common"))
    scored = scored.withColumn("score", F.round(2 * F.col("common") / (F.col("n") + F.col("b")), 6)).where(2 * F.col("common") >= threshold * (F.col("n") + F.col("b")))
    passages = _new_passages(runs, scored, most).select("doc_id", "th", F.when(F.col("counts"), F.concat_ws("/", "a", "t")).alias("match"), "id", "score")
    matches = scored.select("doc_id", "th", F.col("segment").cast("string").alias("match"), "id", "score").unionByName(passages)
    best = matches.groupBy("doc_id", "th").agg(
        F.min(F.struct((-F.col("score")).alias("score"), "id")).alias("best"), F.countDistinct("match").alias("n_matches"), F.array_join(F.array_sort(F.collect_set("id")), ",").alias("licenses")
    )
    l, r = rows.select("doc_id", "th").alias("l"), best.alias("r")
    out = l.join(r, F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.th") == F.col("r.th")), "left")
    return out.select("l.doc_id", F.col("best.id").alias("license"), (-F.col("best.score")).alias("score"), F.coalesce("n_matches", F.lit(0)).alias("n_matches"), "licenses")


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    values = ", ".join(f"({i}, '{name}', '{g}')" for i, (name, text) in enumerate(TEMPLATES) for g in template_bigrams(text))
    return f"""
WITH g(t, id, g) AS (VALUES {values}),
tpl AS (SELECT t, id, count(*) AS b FROM g GROUP BY t, id),
c AS (SELECT doc_id, regexp_replace(replace(lower(text), chr(13), ' '), '[^a-z0-9\\n]+', ' ', 'g') AS clean FROM documents),
seg AS (
  SELECT doc_id, i AS segment, lines[i] AS line FROM (SELECT doc_id, string_split(clean, chr(10)) AS lines FROM c), LATERAL unnest(range(1, len(lines) + 1)) AS u(i)
  UNION ALL SELECT doc_id, 0, replace(clean, chr(10), ' ') FROM c WHERE contains(clean, chr(10))
),
w AS (SELECT doc_id, segment, string_split(trim(regexp_replace(line, ' +', ' ', 'g')), ' ') AS words FROM seg),
b AS (SELECT DISTINCT doc_id, segment, words[i] || ' ' || words[i + 1] AS g FROM w, LATERAL unnest(range(1, len(words))) AS u(i)),
n AS (SELECT doc_id, segment, count(*) AS n FROM b GROUP BY ALL),
m AS (SELECT doc_id, segment, t, count(*) AS common FROM b JOIN g USING (g) GROUP BY ALL),
s AS (
  SELECT m.doc_id, m.segment, id, round(2.0::DOUBLE * common / (n + tpl.b), 6) AS score
  FROM m JOIN n ON m.doc_id = n.doc_id AND m.segment = n.segment JOIN tpl USING (t) WHERE 2 * common >= {THRESHOLD} * (n + tpl.b)
),
best AS (
  SELECT doc_id, arg_min(id, (-score, id)) AS license, max(score) AS score, count(DISTINCT segment) AS n_matches, string_agg(DISTINCT id, ',' ORDER BY id) AS licenses
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, license, score, coalesce(n_matches, 0) AS n_matches, licenses FROM documents d LEFT JOIN best USING (doc_id)
"""


ORACLE_OP9 = _oracle()
