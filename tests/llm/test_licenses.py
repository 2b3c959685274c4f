import re

import duckdb
import pytest

from conftest import SF_CHECK
from llm_cases import EDGES, documents  # noqa: F401
from strata.llm import licenses, queries


def test_every_known_sentence_passes_the_keyword_screen():
    for name, text in licenses.SENTENCES:
        assert re.search(f"(?i){licenses.KEYWORDS}", text) or name == "APACHE_COPY", name
    names = {n for n, _ in licenses.SENTENCES}
    assert all(set(ids) <= names for _, ids in licenses.RULES)
    assert len(set(licenses.known_sentences())) == len(licenses.known_sentences())


def brute(text):
    known = licenses.known_sentences()
    text = text or ""
    ends = r"[.!?;:]+[ \t\r\n]+|[.!?;:]+$"
    read = lambda parts: [known[n] for p in parts if (n := licenses.normal(p)) in known]
    by_line = read(s for line in text.split("\n") for s in re.split(ends, line))
    joined = read(re.split(ends, text.replace("\n", " ")))

    def match(ids):
        left, found = "".join(f",{i}," for i in ids), []
        for name, rule in licenses.RULES:
            rule = "".join(f",{i}," for i in rule)
            if rule in left:
                left = left.replace(rule, "|")
                found.append(name)
        return found

    found = list(dict.fromkeys(match(by_line) + match(joined)))
    more = list(dict.fromkeys(i for i in joined if i not in by_line))
    return ",".join(found), ",".join(by_line + more)


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://example.com"""
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
       'documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation '
       "the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and "
       "to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above "
       "copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n")
CASES = [*EDGES, (20, APACHE), (21, MIT), (22, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nmore"),
         (23, "RELEASED UNDER THE  MIT   LICENSE!"), (24, "Not released under the MIT License"), (25, "licence license copyright"),
         (26, "This work is licensed under the GNU General\nPublic License, version 3.")]


def test_edges_match_the_plain_form(spark, documents):  # noqa: F811
    got = {(r["doc_id"], r["licenses"], r["sentence_ids"]) for r in licenses.scan(documents(CASES, "licenses")).collect()}
    assert got == {(i, *brute(t)) for i, t in CASES}
    by_id = {i: found for i, found, _ in got}
    assert (by_id[20], by_id[21], by_id[22], by_id[23], by_id[24], by_id[26]) == (
        "Apache-2.0", "MIT", "MIT,CC-BY-NC-4.0", "MIT", "", "GPL-3.0")
    assert licenses.scan(documents(CASES).limit(0)).count() == 0


def test_query_matches_the_plain_form_and_its_sql(spark):
    docs = queries.table(spark, SF_CHECK, "documents").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.op3_license_scan(spark, SF_CHECK).collect())
    assert got == sorted((i, *brute(t)) for i, t in map(tuple, docs)) and any(x for _, x, _ in got)


def test_no_python_on_the_path(spark):
    plan = queries.op3_license_scan(spark, SF_CHECK)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


BSD = """Copyright (c) 2024, Example Holder
All rights reserved
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above
   copyright notice, this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors may
   be used to endorse or promote products derived from this software without specific prior written permission.
"""
GPL = """ * Some program
 * Copyright (C) 2024  Some Author
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
"""
NOTICES = {1: ("MIT License\n\nCopyright (c) 2024 X\n\n" + MIT, "MIT"), 2: ("Copyright 2024 X\n" + MIT, "MIT"),
           3: (BSD, "BSD-2-Clause"), 4: (BSD + ENDORSE, "BSD-3-Clause"), 5: (GPL, "GPL-3.0-or-later"),
           6: (GPL.replace(" *\n", ""), "GPL-3.0-or-later"), 7: ("Intro\n\n" + GPL.replace(" * ", "    ").replace(" *\n", "\n"), "GPL-3.0-or-later"),
           8: (("MIT License\n\nCopyright (c) 2024 X\n\n" + MIT).replace("\n", "\r\n"), "MIT"),
           9: (GPL + "\n" + BSD + ENDORSE + "\nMIT License\n\nCopyright (c) 2024 X\n\n" + MIT, "BSD-3-Clause,GPL-3.0-or-later,MIT")}


NOTICES[10] = (BSD + ENDORSE.replace("the copyright holder", "Example Widgets Inc"), "BSD-3-Clause")
NOTICES[12] = (BSD + ENDORSE.replace("the copyright holder", "Example Inc."), "BSD-3-Clause")
NOTICES[11] = (BSD + ENDORSE.replace("the copyright holder", "the\n   University of Somewhere"), "BSD-3-Clause")


def test_whole_notices_under_copyright_lines(spark, documents):  # noqa: F811
    got = licenses.scan(documents([(i, t) for i, (t, _) in NOTICES.items()])).collect()
    assert {r["doc_id"]: ",".join(sorted(r["licenses"].split(","))) for r in got} == {i: want for i, (_, want) in NOTICES.items()}
