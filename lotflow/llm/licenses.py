"""Licence scan by TF-IDF cosine, with inheritance from directories.

Method: a file is compared with licence templates as sparse TF-IDF vectors at
three sizes: its lines and sentences with one-line notices and SPDX identifiers,
its sentences over joined lines (comment signs are no words) with standard
headers and titles, and the whole file with whole licence texts; document
frequencies are those of all files. A file that states no licence inherits that
of the nearest directory above it that has a licence file. DataFrame and SQL
functions only.

Most lines cannot reach the threshold: by the Cauchy-Schwarz inequality a line
without any of a template's anchors (its rarest words, so many that the rest
weighs less than the threshold) has too small a cosine. Only units with an anchor
are weighed, which drops none that could pass.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.llm.common import table
from lotflow.session import local_table, materialize

# Licences and their usual statements.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "Redistribution and use under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Redistribution and use under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0"),
    ("Proprietary", "All rights reserved."),
)
# SPDX identifiers of these and other usual licences.
SPDX = (
    ("0BSD", "0BSD"), ("AGPL-3.0", "AGPL-3.0"), ("Apache-2.0", "Apache-2.0"), ("BSD-2-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD-3-Clause"),
    ("BSL-1.0", "BSL-1.0"), ("CC-BY-4.0", "CC-BY-4.0"), ("CC-BY-NC-4.0", "CC-BY-NC-4.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("CC0-1.0", "CC0-1.0"),
    ("EPL-2.0", "EPL-2.0"), ("GPL-2.0", "GPL-2.0"), ("GPL-3.0", "GPL-3.0"), ("ISC", "ISC"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3.0"),
    ("MIT", "MIT"), ("MPL-2.0", "MPL-2.0"), ("Unlicense", "Unlicense"), ("Zlib", "Zlib"),
)
# Title lines; the words that a line must hold.
TITLES = (
    ("BSD-2-Clause", "BSD 2-Clause License", "bsd 2 clause"),
    ("BSD-3-Clause", "BSD 3-Clause License", "bsd 3 clause"),
    ("ISC", "ISC License", "isc license"),
    ("MIT", "The MIT License (MIT)", "mit license"),
)
_GNU = "it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version"
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:"""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies"""
_0BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met:"""
_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission"""
_ZLIB = """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:"""
_UNLICENSE = "This is free and unencumbered software released into the public domain"
# Sentences of standard headers and titles of licence files; the words that a sentence must hold.
HEADERS = (
    ("0BSD", _0BSD, "permission granted fee"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "affero version november"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify " + _GNU.format("Affero General Public License", ",", "3"), "affero 3"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "apache version 2 january"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License', "apache 2"),
    ("BSD-2-Clause", _BSD, "redistribution binary forms"),
    ("BSD-3-Clause", _BSD_NAMES, "neither endorse"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "general version 2 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify " + _GNU.format("General Public License", ";", "2"), "general 2"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "general version 3 29"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify " + _GNU.format("General Public License", ",", "3"), "general 3"),
    ("ISC", _ISC, "permission granted notice"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "lesser version 2 february"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify " + _GNU.format("Lesser General Public License", ";", "2.1"), "lesser 2"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "lesser version 3 29"),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify " + _GNU.format("Lesser General Public License", ",", "3"), "lesser 3"),
    ("MIT", _MIT, "permission granted sublicense"),
    ("MPL-2.0", "Mozilla Public License Version 2.0", "mozilla version 2"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v", "mozilla"),
    ("Unlicense", _UNLICENSE, "unencumbered"),
    ("Zlib", _ZLIB, "permission redistribute restrictions"),
)
_MIT_END = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_CLAUSES = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_TITLE = "{} Copyright (c) year copyright holder "
# Whole texts of licences that files hold as they are; the words that a file must hold.
WHOLE = (
    ("0BSD", f"BSD Zero Clause License {_0BSD}. {_ISC_END}", "permission granted fee"),
    ("BSD-2-Clause", f"{_TITLE.format('BSD 2-Clause License')} {_BSD} {_BSD_CLAUSES} {_BSD_END}", "redistribution binary forms"),
    ("BSD-3-Clause", f"{_TITLE.format('BSD 3-Clause License')} {_BSD} {_BSD_CLAUSES} 3. {_BSD_NAMES}. {_BSD_END}", "redistribution neither endorse"),
    ("ISC", f"{_TITLE.format('ISC License')} {_ISC}. {_ISC_END}", "permission granted notice"),
    ("MIT", f"{_TITLE.format('MIT License')} {_MIT} {_MIT_NOTICE} {_MIT_END}", "permission granted sublicense"),
)
#: Licences with a sentence that another holds too, which is meant if it is stated as well.
WITHIN = {"BSD-2-Clause": "BSD-3-Clause"}
THRESHOLD = 0.7
#: A licence file states licences in at least one character of so many, or has one of these names and states one.
FILE_SHARE, FILE_NAME = 4, "(?i)^(licen[cs]e|copying|unlicense)([._-].*)?$"
WORD_CUT, LINE_CUT = "[^a-z0-9]+", "[.!?][ \\t\\r\\n]+|\\n"
#: Sentences over joined lines end at a line without letters or digits.
SENTENCE_CUT = "[.!?][ \\t\\r\\n]+|\\n[^A-Za-z0-9]*\\n"
#: Sizes of the parts of a file: lines, sentences, whole.
LINE, SENTENCE, FILE = 0, 1, 2


def templates() -> list[tuple[int, str, str, int, str, str, str]]:
    """``id, license, slot, level, statement, must, within`` of all templates.

    Of the templates of one slot only the best counts for a part of a file: SPDX
    identifiers have one each, as a line can name several. ``must``: words that a
    part has to hold; ``within``: the licence that is meant if both are stated.
    """
    rows = [(name, "", LINE, text, "", "") for name, text in TEMPLATES]
    rows += [(name, name, LINE, f"SPDX-License-Identifier: {ident}", "spdx " + re.sub(WORD_CUT, " ", ident.lower()), "") for name, ident in SPDX]
    rows += [(name, "", LINE, text, must, "") for name, text, must in TITLES]
    rows += [(name, "", SENTENCE, text, must, WITHIN.get(name, "")) for name, text, must in HEADERS]
    rows += [(name, "", FILE, text, must, "") for name, text, must in WHOLE]
    return [(i, *row) for i, row in enumerate(rows)]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_CUT), "")


def document_frequency(files: DataFrame) -> DataFrame:
    """``word, df``: number of files that hold each word."""
    return files.select(F.explode(F.array_distinct(words(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))


def anchors(template_words: list[tuple], threshold: float) -> list[str]:
    """The rarest words of each template until the rest weighs less than the threshold; rows of ``id, word, df, weight``."""
    chosen: set[str] = set()
    by_template: dict[int, list] = {}
    for number, word, df, weight in template_words:
        by_template.setdefault(number, []).append((df, -(weight**2), word))
    for rows in by_template.values():
        total = rest = -sum(w for _, w, _ in rows)
        for _, weight, word in sorted(rows):
            if rest < (threshold - 1e-9) ** 2 * total:
                break
            chosen.add(word)
            rest += weight
    return sorted(chosen)


def statements(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``key, license, score, chars, own`` for each licence that a text of ``files(key, text)`` states.

    ``score``: the best of its parts that state it. ``chars``: of all parts of one
    size that state any licence, the most. ``own`` is false if only parts that the
    licence in ``WITHIN`` holds as well state it.
    """
    spark = files.sparkSession
    total = files.count()
    frequency = materialize(document_frequency(files), "frequency")
    fixed = local_table(spark, templates(), "id int, license string, slot string, level int, statement string, must string, within string")
    vocabulary = fixed.select("id", "level", F.split("must", " ").alias("must"), F.explode(words(F.col("statement"))).alias("word"))
    vocabulary = vocabulary.groupBy("id", "level", "word").agg(F.count("*").alias("tf"), F.max(F.array_contains("must", F.col("word")).cast("int")).alias("must"))
    idf = F.log((1.0 + total) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0
    # Fixed rows of the code: a few thousand.
    vocabulary = vocabulary.join(frequency, "word", "left").select("id", "level", "word", F.coalesce("df", F.lit(0)), (F.col("tf") * idf).alias("w"), "must").collect()
    norms: dict[int, float] = {}
    for number, _, _, _, weight, _ in vocabulary:
        norms[number] = norms.get(number, 0.0) + weight**2
    known = [(n, level, word, float(w / math.sqrt(norms[n])), must) for n, level, word, _, w, must in vocabulary]
    known = local_table(spark, known, "id int, level int, word string, weight double, must int")
    needed = {level: anchors([(n, word, df, w) for n, at, word, df, w, _ in vocabulary if at == level], threshold) for level in (LINE, SENTENCE, FILE)}
    literal = lambda found: F.array(*(F.lit(a) for a in found))

    held = files.where(F.arrays_overlap(words(F.col("text")), literal(sorted(set().union(*needed.values())))))
    part = lambda level, line, text: F.struct(F.lit(level).alias("level"), line.alias("line"), text.alias("segment"))
    cut = lambda level, at: F.transform(F.split("text", at), lambda x, i: part(level, i, x))
    parts = held.select("key", F.explode(F.concat(cut(LINE, LINE_CUT), cut(SENTENCE, SENTENCE_CUT), F.array(part(FILE, F.lit(0), F.col("text"))))).alias("p"))
    parts = parts.select("key", "p.*").withColumn("words", words(F.col("segment")))
    passes = F.lit(False)
    for level, found in needed.items():
        passes = F.when(F.col("level") == level, F.arrays_overlap("words", literal(found))).otherwise(passes)
    terms = parts.where(passes).select("key", "level", "line", F.length("segment").alias("chars"), F.explode("words").alias("word"))
    terms = terms.groupBy("key", "level", "line", "chars", "word").agg(F.count("*").alias("tf"))
    weighed = materialize(terms.join(frequency, "word").select("key", "level", "line", "chars", "word", (F.col("tf") * idf).alias("w")), "terms")
    norm = weighed.groupBy("key", "level", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(known), ["level", "word"]).groupBy("key", "level", "line", "chars", "id")
    dots = dots.agg(F.sum(F.col("w") * F.col("weight")).alias("dot"), F.sum("must").alias("held"))
    needs = fixed.select("id", "license", "slot", "within", F.size(F.array_remove(F.split("must", " "), "")).alias("needs"))
    dots = dots.join(F.broadcast(needs), "id").where("held = needs")
    scored = dots.join(norm, ["key", "level", "line"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= threshold)
    best = scored.groupBy("key", "level", "line", "chars", "slot").agg(F.min(F.struct((-F.col("score")).alias("s"), "license", "within")).alias("b"))
    stated = materialize(best.select("key", "level", "line", "chars", "b.license", "b.within", (-F.col("b.s")).alias("score")), "stated")
    chars = stated.select("key", "level", "line", "chars").distinct().groupBy("key", "level").agg(F.sum("chars").alias("chars"))
    chars = chars.groupBy("key").agg(F.max("chars").cast("long").alias("chars"))
    named = stated.groupBy("key", "license").agg(F.max("score").alias("score"), F.max(F.col("within") == "").alias("own"))
    return named.join(chars, "key")


def scan_licenses(files: DataFrame, path_col: str = "path", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``path, licenses, score, license, origin, from_path`` of every file.

    ``licenses``: all that the file states, by name; ``score`` the highest cosine;
    ``license``: the one with the highest (by name if equal), or that of the
    nearest directory above with a licence file, or null. ``origin``: own,
    inherited or none. A licence file states licences in a quarter of its
    characters or more, or is named like one and states any; of several in a
    directory the highest score, then the smallest path counts. Null text counts as
    empty; a null path has no directory. Repeated rows each get theirs, other
    columns are left out, an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = files.select(F.col(path_col).alias("path"), text.alias("text"))
    keyed = rows.withColumn("key", F.unhex(F.sha2(F.concat_ws("/", F.length("path").cast("string"), "path", "text"), 256)))
    found = statements(keyed.select("key", "text"), threshold)
    # At most as many rows of a file as there are licences.
    own = found.groupBy("key", "chars").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "license", "own")).alias("all"))
    names = F.transform("all", lambda x: x["license"])
    wider = F.create_map(*(F.lit(v) for pair in WITHIN.items() for v in pair))
    meant = F.filter("all", lambda x: x["own"] | ~F.coalesce(F.array_contains("names", wider[x["license"]]), F.lit(False)))
    own = own.withColumn("names", names).withColumn("all", meant).withColumn("best", F.array_min("all"))
    licenses = F.array_join(F.array_sort(F.transform("all", lambda x: x["license"])), ",")
    own = materialize(own.select("key", licenses.alias("licenses"), F.col("best.license").alias("license"), (-F.col("best.s")).alias("score"), "chars"), "licenses")
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    paths = keyed.select("path", "key", F.length("text").cast("long").alias("length"), folder.alias("folder"))
    stated = paths.join(own, "key", "left")

    file_like = (FILE_SHARE * F.col("chars") >= F.col("length")) | F.regexp_extract("path", "([^/]*)$", 1).rlike(FILE_NAME)
    files_of = paths.join(own, "key").where(file_like)
    files_of = files_of.where("path IS NOT NULL").groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("f"))
    files_of = files_of.select(F.col("folder").alias("above"), F.col("f.license").alias("given"), F.col("f.path").alias("from_path"))
    folders = paths.where("path IS NOT NULL").select("folder").distinct()
    parts = F.split("folder", "/")
    # A directory and all above it, down to the root, named by an empty text.
    above = folders.select("folder", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"), parts.alias("parts"))
    above = above.select("folder", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("above"))
    nearest = above.join(files_of, "above").groupBy("folder").agg(F.max(F.struct("depth", "given", "from_path")).alias("n"))
    nearest = nearest.select("folder", "n.given", "n.from_path")
    out = stated.join(nearest, "folder", "left")
    states = F.col("licenses").isNotNull()
    inherits = ~states & F.col("given").isNotNull()
    return out.select(
        F.col("path").alias(path_col), F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("license", "given").alias("license"), F.when(states, "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(inherits, F.col("from_path")).alias("from_path"),
    )


def op8_licenses(spark, sf_dir: str) -> DataFrame:
    """Licences of all documents, as files in a tree of source, thousand and hundred."""
    docs = table(spark, sf_dir, "documents")
    part = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    path = F.concat_ws("/", "source", part(1000), part(100), F.col("doc_id").cast("string"))
    found = scan_licenses(docs.select(path.alias("path"), "text"))
    return found.select(F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id"), *found.columns)
