"""Licence recognition by sentence rules, in DataFrame expressions only.

Texts are split into sentences and normalised; known sentences become
identifiers; the identifier sequence of a document is matched against ordered
licence rules, longest evidence first, and a rule consumes the identifiers it
matches so that a more general rule cannot count them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENTENCE_END = r"[.!?;:]+[ \t\r\n]+|[.!?;:]+$"
#: A line that is a copyright notice, also behind comment signs ("copyright notice" and "copyright holder" are none).
COPYRIGHT_LINE = (r"(?dm)^[^A-Za-z0-9©\n]*(?:(?i:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|by\b)|c\)[ \t]|©|all rights reserved)"
                  r"|Copyright[ \t]+(?!notice|holder|owner|law))[^\n]*$")
#: Blank lines, also those of a comment.
PARAGRAPH_END = r"\n(?:[ \t\r#*/;%-]*\n)+"
#: Every known sentence holds one of these, so texts without them need no look.
KEYWORDS = "licen[cs]e|copyright|copyleft|redistribut|permission|public domain|warrant|free software"

# Licence notices in common use, as their authors publish them.
SENTENCES: list[tuple[str, str]] = [
    ("APACHE2_SHORT", "Licensed under the Apache License, Version 2.0"),
    ("APACHE2_SHORT", "This work is licensed under the Apache License, Version 2.0"),
    ("APACHE2_SHORT", "Released under the Apache License, Version 2.0"),
    ("APACHE2_SHORT", 'Licensed under the Apache License, Version 2.0 (the "License")'),
    ("APACHE_MAY_NOT", "you may not use this file except in compliance with the License"),
    ("APACHE_COPY", "You may obtain a copy of the License at"),
    ("MIT_SHORT", "Released under the MIT License"),
    ("MIT_SHORT", "Licensed under the MIT License"),
    ("MIT_SHORT", "This work is licensed under the MIT License"),
    ("MIT_GRANT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  'associated documentation files (the "Software"), to deal in the Software without restriction, '
                  "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                  "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                  "furnished to do so, subject to the following conditions"),
    ("MIT_NOTICE", "The above copyright notice and this permission notice shall be included in all copies or "
                   "substantial portions of the Software"),
    ("BSD_GRANT", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met"),
    ("BSD_SOURCE", "Redistributions of source code must retain the above copyright notice, this list of conditions "
                   "and the following disclaimer"),
    ("BSD_BINARY", "Redistributions in binary form must reproduce the above copyright notice, this list of "
                   "conditions and the following disclaimer in the documentation and/or other materials provided "
                   "with the distribution"),
    ("BSD_ENDORSE", "Neither the name of the copyright holder nor the names of its contributors may be used to "
                    "endorse or promote products derived from this software without specific prior written permission"),
    # what follows a holder's name that ends in a full stop
    ("BSD_ENDORSE", "nor the names of its contributors may be used to endorse or promote products derived from this "
                    "software without specific prior written permission"),
    ("BSD2_SHORT", "Licensed under the BSD 2-Clause License"),
    ("BSD3_SHORT", "Licensed under the BSD 3-Clause License"),
    ("GPL3_SHORT", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL3_SHORT", "Licensed under the GNU General Public License, version 3"),
    ("GPL3_SHORT", "Released under the GNU General Public License, version 3"),
    ("GPL2_SHORT", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL2_SHORT", "Licensed under the GNU General Public License, version 2"),
    ("GPL_GRANT", "This program is free software"),
    ("GPL_ANY_3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                  "any later version"),
    ("GPL_ANY_2", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation; either version 2 of the License, or (at your option) "
                  "any later version"),
    ("LGPL3_SHORT", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL3_SHORT", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL2_SHORT", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC_BY_SHORT", "Licensed under CC BY 4.0"),
    ("CC_BY_SHORT", "This work is licensed under CC BY 4.0"),
    ("CC_BY_SHORT", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC_BY_SA_SHORT", "Licensed under CC BY-SA 4.0"),
    ("CC_BY_SA_SHORT", "This work is licensed under CC BY-SA 4.0"),
    ("CC_BY_SA_SHORT", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC_BY_NC_SHORT", "Licensed under CC BY-NC 4.0"),
    ("CC_BY_NC_SHORT", "This work is licensed under CC BY-NC 4.0"),
    ("CC_BY_NC_SHORT", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0_SHORT", "This work is dedicated to the public domain under the CC0 1.0 license"),
]

#: Ordered rules: licence and the identifiers that must follow one another.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("APACHE2_SHORT", "APACHE_MAY_NOT", "APACHE_COPY")),
    ("Apache-2.0", ("APACHE2_SHORT",)),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE")),
    ("MIT", ("MIT_SHORT",)),
    ("BSD-3-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ENDORSE")),
    ("BSD-2-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY")),
    ("BSD-2-Clause", ("BSD2_SHORT",)),
    ("BSD-3-Clause", ("BSD3_SHORT",)),
    ("GPL-3.0-or-later", ("GPL_GRANT", "GPL_ANY_3")),
    ("GPL-2.0-or-later", ("GPL_GRANT", "GPL_ANY_2")),
    ("GPL-3.0", ("GPL3_SHORT",)),
    ("GPL-2.0", ("GPL2_SHORT",)),
    ("LGPL-3.0", ("LGPL3_SHORT",)),
    ("AGPL-3.0", ("AGPL3_SHORT",)),
    ("MPL-2.0", ("MPL2_SHORT",)),
    ("CC-BY-NC-4.0", ("CC_BY_NC_SHORT",)),
    ("CC-BY-SA-4.0", ("CC_BY_SA_SHORT",)),
    ("CC-BY-4.0", ("CC_BY_SHORT",)),
    ("CC0-1.0", ("CC0_SHORT",)),
]


#: The slot for a holder's name in a normalised sentence, and what is read in its place.
HOLDER = "^neither the names? of .{1,300} nor the names of (?:its|their|any) contributors may be used to endorse"
HELD = "neither the name of the copyright holder nor the names of its contributors may be used to endorse"


def normal(sentence: str) -> str:
    """Lower-case A-Z; every run of other characters than a-z and 0-9 is one space; any holder's name stands for all."""
    import re

    return re.sub(HOLDER, HELD, re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip(" "))


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier.

    A known sentence that itself contains sentence ends is registered by its
    last part too long texts being cut there as well ("; either version 2 ...").
    """
    import re

    out: dict[str, str] = {}
    for name, text in SENTENCES:
        parts = [p for p in re.split(r"[.!?;:]+\s+", text) if normal(p)]
        out[normal(max(parts, key=len))] = name
    return out


def _normal(sentence: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), "[^a-z0-9]+", " ")), HOLDER, HELD)


def _identifiers(sentences: str, known: dict[str, str]) -> Column:
    """``(at, id)`` of the known ones in column ``sentences``; ``at`` counts the letters and digits before a
    sentence, so readings that differ in white space and cuts agree on it."""
    lookup = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    found = F.filter(F.transform(sentences, lambda s, i: F.struct(i.alias("i"), F.try_element_at(lookup, _normal(s)).alias("id"))),
                     lambda s: s["id"].isNotNull())
    sizes = F.transform(sentences, lambda s: F.length(F.regexp_replace(s, "[^A-Za-z0-9]+", "")))
    return F.transform(found, lambda s: F.struct(
        F.aggregate(F.slice(sizes, F.lit(1), s["i"]), F.lit(0), lambda n, x: n + x).alias("at"), s["id"].alias("id")))


def _match(sequence: Column) -> Column:
    """Licences of an identifier sequence written as ``,A,,B,,C,``; matched identifiers are consumed."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f",{i}," for i in ids)).alias("ids"))
                      for name, ids in RULES])
    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found"))
    return F.aggregate(
        rules, start,
        lambda s, r: F.when(F.contains(s["left"], r["ids"]), F.struct(
            F.replace(s["left"], r["ids"], F.lit("|")).alias("left"),
            F.concat(s["found"], F.array(r["name"])).alias("found"))).otherwise(s),
        lambda s: F.array_distinct(s["found"]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, licenses, sentence_ids)`` per document, both comma-joined.

    Sentences are read line by line, with lines joined, so notices broken over
    lines are recognised, and with the lines of a paragraph joined, copyright
    lines apart.  The rules run on one sequence that merges the readings by
    position.  ``sentence_ids`` are those of the line reading followed by those
    that only the joined readings find.  Null and empty texts give empty
    strings; null and repeated ids keep their rows; an empty table gives an
    empty result; extra columns are ignored.
    """
    known = known_sentences()
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = docs.select(col(id_col).alias("doc_id"), text.alias("text"))
    look = F.col("text").rlike(f"(?i)({KEYWORDS})")
    none = F.array().cast("array<string>")
    sentences = lambda part: F.split(F.replace(part, F.lit("\n"), F.lit(" ")), SENTENCE_END)
    by_line = F.flatten(F.transform(F.split("text", "\n"), lambda line: F.split(line, SENTENCE_END)))
    apart = F.split(F.regexp_replace("text", COPYRIGHT_LINE, "\n\n$0\n\n"), PARAGRAPH_END)
    readings = {"by_line": by_line, "joined": sentences(F.col("text")), "paragraphs": F.flatten(F.transform(apart, sentences))}
    rows = rows.select("doc_id", *[F.when(look, x).otherwise(none).alias(k) for k, x in readings.items()])
    rows = rows.select("doc_id", *[_identifiers(k, known).alias(k) for k in readings])

    def found(places: Column | str) -> Column:
        return _match(F.array_join(F.transform(places, lambda p: F.concat(F.lit(","), p["id"], F.lit(","))), ""))

    merged = F.array_sort(F.array_distinct(F.concat(*readings)))
    rows = rows.select("doc_id", *readings, merged.alias("merged"), *[F.transform(k, lambda p: p["id"]).alias(f"{k}_ids") for k in readings])
    # licences of the merged sequence, first those that the line reading shows alone, then the joined one
    order = F.array_union(F.array_union(found("by_line"), found("joined")), found("merged"))
    more = F.array_except(F.array_union("joined_ids", "paragraphs_ids"), "by_line_ids")
    return rows.select("doc_id", F.array_join(F.when(F.size("merged") == 0, none).otherwise(
        F.array_intersect(order, found("merged"))), ",").alias("licenses"),
        F.array_join(F.concat("by_line_ids", more), ",").alias("sentence_ids"))
