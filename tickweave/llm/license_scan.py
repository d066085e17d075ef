"""License scans: ordered signature rules over the words of a text.

A text becomes its lower-cased words joined by single spaces. In these each rule's keyword, which every
match of its pattern holds, is looked for; a text with none of them has no detection. The rules whose
keyword is there look for their pattern; every match is a detection with its place. Rules have a
priority: a tag or a license's own text before a full phrase, a phrase before a name. A detection goes if one of the same or a
better priority contains its interval (of equal intervals the first rule's stays).

The phrases of PHRASES are found apart, all places of them, and their labels always stay. Null and empty
texts have no words and no detections; very long ones are scanned whole. Every input row gives one row,
repeated rows too, and an empty table none. Everything happens within a row; nothing is shuffled. Of the
columns only those kept and text are read. Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Words and their complement, once A-Z is lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label, keyword, pattern of the name in words, versions ("" for none).
FAMILIES = (
    ("mit", "mit", "mit", ("",)),
    ("mit", "expat", "expat", ("",)),
    ("apache", "apache", "apache(?: software)?", ("", "1", "1 1", "2", "2 0")),
    ("bsd", "bsd", "bsd", ("", "2 clause", "3 clause", "4 clause")),
    ("gpl", "general public", "(?:gnu )?general public", ("", "1", "2", "3")),
    ("lgpl", "general public", "(?:gnu )?(?:lesser|library) general public", ("", "2", "2 1", "3")),
    ("agpl", "affero", "(?:gnu )?affero general public", ("", "1", "3")),
    ("gfdl", "documentation", "(?:gnu )?free documentation", ("", "1 1", "1 2", "1 3")),
    ("mpl", "mozilla", "mozilla public", ("", "1 0", "1 1", "2 0")),
    ("epl", "eclipse", "eclipse public", ("", "1 0", "2 0")),
    ("cddl", "common development", "common development and distribution", ("", "1 0", "1 1")),
    ("eupl", "european union", "european union public", ("", "1 1", "1 2")),
    ("artistic", "artistic", "artistic", ("", "1 0", "2 0")),
    ("bsl", "boost", "boost software", ("", "1 0")),
    ("isc", "isc", "isc", ("",)),
    ("zlib", "zlib", "zlib", ("",)),
    ("unlicense", "unlicense", "(?:the )?unlicense", ("",)),
    ("wtfpl", "public", "do what the f(?:uck|k) you want to public", ("", "2")),
    ("psf", "python", "python software foundation", ("", "2")),
    ("openssl", "openssl", "openssl", ("",)),
    ("postgresql", "postgresql", "postgresql", ("",)),
    ("php", "php", "php", ("", "3 0", "3 01")),
    ("ofl", "open font", "(?:sil )?open font", ("", "1 0", "1 1")),
    ("odbl", "open database", "open database", ("", "1 0")),
    ("odc-by", "attribution", "open data commons attribution", ("", "1 0")),
    ("ms-pl", "microsoft", "microsoft public", ("",)),
    ("osl", "open software", "open software", ("", "2 1", "3 0")),
    ("afl", "academic free", "academic free", ("", "2 1", "3 0")),
    ("cpl", "common public", "common public", ("", "1 0")),
    ("ipl", "ibm", "ibm public", ("", "1 0")),
    ("upl", "universal", "universal permissive", ("", "1 0")),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", ("",)),
    ("w3c", "w3c", "w3c(?: software)?", ("",)),
    ("zpl", "zope", "zope public", ("", "2 0", "2 1")),
    ("cecill", "cecill", "cecill", ("", "1 0", "2 0", "2 1")),
    ("mulan", "mulan", "mulan permissive software", ("", "1", "2")),
    ("elastic", "elastic", "elastic", ("", "2 0")),
    ("sspl", "server side", "server side public", ("", "1")),
    ("busl", "business source", "business source", ("", "1 1")),
)
CC_PARTS = (
    ("by", "attribution"), ("by-sa", "attribution share(?: )?alike"), ("by-nd", "attribution no(?: )?deriv(?:s|atives)"), ("by-nc", "attribution non(?: )?commercial"),
    ("by-nc-sa", "attribution non(?: )?commercial share(?: )?alike"), ("by-nc-nd", "attribution non(?: )?commercial no(?: )?deriv(?:s|atives)"),
)
#: Label, keyword, pattern of what licenses and their notices say.
TEXTS = (
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "substantial portions", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "merchantability", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("x11", "advertising or otherwise", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("isc", "with or without fee", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "disclaims all warranties", "the software is provided as is and (?:the author|isc) disclaims all warranties with regard to this software"),
    ("ntp", "and its documentation", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("bsd", "source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "copyright holders and contributors", "this software is provided by the copyright holders and contributors as is"),
    ("bsd-3", "names of its contributors", "neither the name of (?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache-2", "except in compliance", "you may not use this file except in compliance with the license"),
    ("apache-2", "as is basis", "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2", "apache org", "apache org licenses license 2 0"),
    ("apache-1.1", "apache software foundation", "this product includes software developed by the apache software foundation"),
    ("gpl", "free software", "is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2", "version 2 of the license", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3", "version 3 of the license", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl", "in the hope that", "distributed in the hope that it will be useful but without any warranty"),
    ("lgpl-2.1", "version 2 1 of the license", "under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license"),
    ("lgpl-3", "version 3 of the license", "under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license"),
    ("agpl-3", "version 3 of the license", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license"),
    ("gfdl", "under the terms of the gnu free", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2", "source code form", "this source code form is subject to the terms of the mozilla public license v(?: )?2 0"),
    ("mpl-1.1", "contents of this file", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("cddl", "contents of this file", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("bsl-1", "person or organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("zlib", "express or implied warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "origin of this software", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "verbatim or modified", "everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("cc0", "to the extent possible under law", "to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright and related or neighboring rights"),
    ("cc-by", "medium or format", "you are free to share copy and redistribute the material in any medium or format"),
    ("ofl-1.1", "font software", "this font software is licensed under the sil open font license version 1 1"),
    ("openssl", "openssl project", "this product includes software developed by the openssl project"),
    ("artistic", "standard version of this package", "you may make and give away verbatim copies of the source form of the standard version of this package"),
    ("json", "not evil", "the software shall be used for good not evil"),
    ("beerware", "retain this notice", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("psf", "python software foundation", "copyright (?:c )?(?:[^ ]+ ){1,12}python software foundation all rights reserved"),
    ("fsfap", "without royalty", "are permitted in any medium without royalty provided the copyright notice and this notice are preserved"),
    ("blue-oak", "blue oak", "blue oak model license"),
    ("all-rights-reserved", "may be reproduced", "no part of this (?:publication|work|book|document|website) may be reproduced"),
    ("proprietary", "written permission", "without (?:the )?(?:prior|express|prior express) written permission of the (?:author|owner|publisher|copyright holder)"),
)
CC_VERSIONS = ("", "1 0", "2 0", "2 5", "3 0", "4 0")


def rules() -> list[tuple[int, str, int, float, str, str]]:
    """(id, label, priority, confidence, keyword, pattern), in order; a version's label holds its numbers."""
    out: list[tuple[str, int, float, str, str]] = []
    verbs = "(?:licen[sc]ed|released|distributed|available|provided|published)"

    def add(label: str, priority: int, confidence: float, keyword: str, pattern: str) -> None:
        out.append((label, priority, confidence, keyword, f"(?<= ){pattern}(?= )"))

    for label, keyword, name, versions in FAMILIES:
        for version in versions:
            full = f"{label}-{version.replace(' clause', '').replace(' ', '.').removesuffix('.0') if label != 'bsd' else version[:1]}" if version else label
            v = f" (?:version |v(?: )?)?{version}" if version and label != "bsd" else ""
            lead = f"{version} " if version and label == "bsd" else ""
            named = f"{lead}{name}(?: style)? licen[sc]e{v}" if not v else f"{name}(?: licen[sc]e)?{v}"
            ids = label.replace("-", " ") + (f" {version}" if version else "")
            add(full, 0, 1.0, "spdx", f"spdx licen[sc]e identifier {ids}(?: only| or later)?")
            add(full, 1, 0.95, keyword, f"{verbs} (?:under|by) (?:the )?(?:terms of )?(?:the )?{named}")
            add(full, 2, 0.8, keyword, named)
    for label, keyword, pattern in TEXTS:
        add(label, 0, 0.98, keyword, pattern)
    for short in ("gpl", "lgpl", "agpl"):
        for version in ("", "2", "2 1", "3"):
            add(f"{short}-{version.replace(' ', '.')}" if version else short, 2, 0.7, short, f"(?:gnu )?{short}(?: (?:version |v(?: )?)?{version}|v{version})" if version else f"(?:gnu )?{short}")
    for parts, words in CC_PARTS:
        for version in CC_VERSIONS:
            label = f"cc-{parts}" + (f"-{version.replace(' ', '.')}" if version else "")
            v = f" {version}" if version else ""
            add(label, 0, 1.0, "spdx", f"spdx licen[sc]e identifier cc {parts.replace('-', ' ')}{v}")
            add(label, 1, 0.95, "creative commons", f"creative commons {words}{v}(?: (?:international|unported|generic))?(?: public)?(?: licen[sc]e)?")
            add(label, 2, 0.8, "cc " + parts.split("-")[0], f"cc {parts.replace('-', ' ')}{v}")
    add("cc0", 1, 0.95, "cc0", "cc0(?: 1 0)?(?: universal)?")
    add("public-domain", 2, 0.7, "public domain", "(?:dedicated to |released into |in )(?:the )?public domain")
    add("all-rights-reserved", 2, 0.6, "rights reserved", "all rights reserved")
    add("proprietary", 2, 0.6, "proprietary", "proprietary(?: and confidential|(?: software)? licen[sc]e)")
    add("copyright", 3, 0.3, "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}")
    add("license-reference", 3, 0.2, "see the", "see the licen[sc]e")
    ordered = sorted(range(len(out)), key=lambda i: (out[i][1], -len(out[i][4]), i))
    return [(n, *out[i]) for n, i in enumerate(ordered)]


def _rule_literal() -> str:
    q = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = [f"named_struct('id', {n}, 'label', {q(label)}, 'prio', {prio}, 'conf', {conf}D, 'kw', {q(kw)}, 're', {q(re)})" for n, label, prio, conf, kw, re in rules()]
    return f"array({', '.join(rows)})"


#: Spans of one rule's matches: places follow from the lengths of what lies between them.
_SPANS = """
transform(
  aggregate(
    arrays_zip(regexp_extract_all(words, r.re, 0), slice(split(words, r.re, -1), 1, size(regexp_extract_all(words, r.re, 0)))),
    named_struct('at', 0, 'spans', cast(array() as array<struct<s:int,e:int>>)),
    (a, m) -> named_struct('at', a.at + length(m['1']) + length(m['0']),
                           'spans', array_append(a.spans, named_struct('s', a.at + length(m['1']), 'e', a.at + length(m['1']) + length(m['0'])))),
    a -> a.spans),
  x -> named_struct('s', x.s, 'back', -x.e, 'prio', r.prio, 'id', r.id, 'label', r.label, 'conf', r.conf))
"""
#: Detections in order of start, then longest, best priority, first rule: one is contained in another
#: of no worse priority if the largest end so far of those is no smaller than its own.
_KEPT = """
aggregate(array_sort(found),
  named_struct('e0', -1, 'e1', -1, 'e2', -1, 'e3', -1, 'kept', cast(array() as array<struct<label:string,conf:double>>)),
  (a, d) -> named_struct(
    'e0', if(d.prio <= 0, greatest(a.e0, -d.back), a.e0), 'e1', if(d.prio <= 1, greatest(a.e1, -d.back), a.e1),
    'e2', if(d.prio <= 2, greatest(a.e2, -d.back), a.e2), 'e3', if(d.prio <= 3, greatest(a.e3, -d.back), a.e3),
    'kept', if(-d.back <= case d.prio when 0 then a.e0 when 1 then a.e1 when 2 then a.e2 else a.e3 end,
               a.kept, array_append(a.kept, named_struct('label', d.label, 'conf', d.conf)))),
  a -> a.kept)
"""


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_words, the base counts and places, base_labels, labels and score of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    low = F.lower(text)
    out = docs.select(*keep, text.alias("__t"), low.alias("__low"))
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.col("__low"), GAP, " ")), F.lit(" "))
    out = out.select(*keep, F.regexp_count(F.col("__t"), F.lit(WORD)).cast("long").alias("n_words"), spaced.alias("words"))
    # the phrases of PHRASES hold keywords as well
    keywords = sorted({r[4] for r in rules()})
    hit = F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.col("words"), k))
    out = out.select(*keep, "n_words", "words", hit.alias("__hit")).withColumn("words", F.when(F.size("__hit") > 0, F.col("words")))

    def before(part: Column) -> Column:
        return (F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))).cast("long")

    backwards = F.reverse("words")
    firsts, lasts, counts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        at, back = F.instr("words", f" {phrase} "), F.instr(backwards, f" {phrase[::-1]} ")
        # what stands before the phrase has as many spaces as words; what stands after it too
        firsts.append(F.when(at > 0, before(F.substring("words", F.lit(1), at - 1))))
        lasts.append(F.when(back > 0, F.col("n_words") - before(F.substring(backwards, F.lit(1), back - 1)) - len(phrase.split())))
        counts.append(F.coalesce(F.regexp_count(F.col("words"), F.lit(f" {phrase}(?= )")), F.lit(0)).cast("long"))
        labels.append(F.when(at > 0, F.lit(label)))
    out = out.select(*keep, "n_words", "words", sum(counts[1:], counts[0]).alias("n_base"), F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"), F.array_compact(F.array(*labels)).alias("__base"), "__hit")
    found = F.expr(f"flatten(transform(filter({_rule_literal()}, r -> array_contains(__hit, r.kw)), r -> {_SPANS}))")
    out = out.select(*keep, "n_words", "n_base", "first_word", "last_word", "__base", F.when(F.size("__hit") > 0, found).alias("found"))
    out = out.select(*keep, "n_words", "n_base", "first_word", "last_word", "__base", F.expr(_KEPT).alias("kept"))
    own = F.coalesce(F.transform("kept", lambda d: d["label"]), F.array().cast("array<string>"))
    score = F.greatest(F.coalesce(F.array_max(F.transform("kept", lambda d: d["conf"])), F.lit(0.0)), F.when(F.size("__base") > 0, 0.9).otherwise(0.0))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return out.select(*keep, "n_words", "n_base", "first_word", "last_word", joined(F.col("__base")).alias("base_labels"), joined(F.concat("__base", own)).alias("labels"), score.alias("score"))


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
