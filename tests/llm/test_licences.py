"""Licence scans against a plain loop."""

import re

from starloom.llm import licences
from starloom.llm.queries import QUERIES


KNOWN, RULES = licences.defaults()


def _plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    sequence = []
    for whole in re.split(licences.SENTENCE_CUTS, lower):
        parts = [whole] if _normal(whole) in KNOWN else re.split(licences.CUTS, whole)
        sequence += [KNOWN[_normal(p)] for p in parts if _normal(p) in KNOWN]
    found, at = [], 0
    while at < len(sequence):
        rule = next(((ids, name) for ids, name in RULES if tuple(sequence[at : at + len(ids)]) == tuple(ids)), None)
        if rule:
            found.append(rule[1])
        at += len(rule[0]) if rule else 1
    return len(sequence), ",".join(found), bool(found)


def _normal(sentence):
    return re.sub("[^a-z0-9]+", " ", sentence).strip(" ")


CASES = [
    None, "", "Released under the MIT License.", "x. RELEASED under: the MIT license!  Licensed under CC BY-NC 4.0.\nAll rights reserved",
    'Licensed under the Apache License, Version 2.0 (the "License"); \nYou may not use this file except in compliance with the License. You may obtain a copy of the License at\n',
    "This program is free software. nothing. This work is licensed under the GNU General Public License, version 3.", "unreleased under the MIT license", "word " * 30_000 + "\nReleased under the MIT License.", "Released under the MIT License.\n" * 50,
]


def test_cases(spark):
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(CASES)] * 2 + [(None, "x", 1)], "doc_id bigint, text string, licences int")
    rows = licences.scan(df).collect()
    assert len(rows) == 2 * len(CASES) + 1
    assert all((r.n_known, r.licences, r.licensed) == _plain(CASES[r.doc_id]) for r in rows if r.doc_id is not None)
    assert _plain(CASES[4]) == (3, "Apache-2.0", True) and licences.scan(df.limit(0)).count() == 0


def test_whole_table(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op5_license_scans"](spark, small).collect()
    assert len(rows) == len(texts) and any(r.licensed for r in rows)
    assert all((r.n_known, r.licences, r.licensed) == _plain(texts[r.doc_id]) for r in rows)


def test_headers_wrapped_and_on_one_line(spark):
    gpl = " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n *\n * x"
    texts = ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "# Licensed under the Apache License,\n# Version 2.0 (the \"License\");\n# you may not use this file except in\n# compliance with the License.\n", gpl, gpl.replace("software: you", "software; you"), "A title\nReleased under the MIT License\nmore text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.licences for r in licences.scan(df).collect()}
    assert found == {0: "Apache-2.0", 1: "Apache-2.0", 2: "GPL-3.0", 3: "GPL-3.0", 4: "MIT"}


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
GNU = "This {what} is free software; you can redistribute it and/or\nmodify it under the terms of the GNU {name} Public\nLicense as published by the Free Software Foundation; {version}.\n"


def test_families_and_full_texts(spark):
    later, only = "either\nversion {} of the License, or (at your option) any later version", "version {} of the License"
    cases = {
        BSD + NAMES: "BSD-3-Clause", BSD: "BSD-2-Clause", MIT: "MIT", "The MIT License (MIT)\n\n" + MIT: "MIT", ISC: "ISC",
        GNU.format(what="library", name="Lesser General", version=later.format("2.1")): "LGPL-2.1",
        GNU.format(what="program", name="General", version=only.format("2")): "GPL-2.0",
        GNU.format(what="program", name="Affero General", version=later.format("3")): "AGPL-3.0",
        GNU.format(what="program", name="General", version=later.format("3")).replace("software; you", "software. You"): "GPL-3.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.": "CC-BY-NC-SA-3.0",
        "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0", "This project is licensed under the BSD 3-Clause License.": "BSD-3-Clause",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.": "MPL-2.0",
        MIT + "\n" + ISC + "\nAll rights reserved.": "MIT,ISC,proprietary",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    found = {r.doc_id: r.licences for r in licences.scan(df).collect()}
    assert found == dict(enumerate(cases.values()))
    assert all(_plain(text)[1] == licence for text, licence in cases.items())


def test_own_tables(spark):
    df = spark.createDataFrame([(1, "Alpha one. Beta two. Alpha one."), (2, "beta two")], "doc_id bigint, text string")
    found = licences.scan(df, {"alpha one": "a.1", "beta two": "ab"}, [(("a.1", "ab"), "X"), (("a.1",), "Y")]).collect()
    assert sorted((r.doc_id, r.n_known, r.licences) for r in found) == [(1, 3, "X,Y"), (2, 1, "")]
