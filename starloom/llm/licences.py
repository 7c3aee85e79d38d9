"""Licence scans: known sentences of licences are recognised, and their order is matched against licence rules.

A text is cut after sentence marks and at blank lines, and what is not known then at line breaks; each sentence is normalised (A-Z lower-cased, all else than
letters a-z and digits one space) and looked up among the known ones. The identifiers of the known sentences, in text
order, form a sequence; rules are ordered sequences of identifiers, tried in their order at each place, leftmost first.
Built-in expressions only, one pass, no shuffle.

Sentences that differ in a name or a version only are made from a template, with one identifier for each licence.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import LOWER, UPPER

#: Ends of sentences and blank lines, and all line breaks besides.
SENTENCE_CUTS = r"\n[\x20\x09\x0B-\x0D]*\n|[.!?;]+[\x20\x09-\x0D]+"
CUTS = r"\n|[.!?;]+[\x20\x09\x0B-\x0D]+"

# Wordings of licences as they are normalised, parts and names in braces.
GNU = {"general": "GPL", "lesser general": "LGPL", "library general": "LGPL", "affero general": "AGPL"}
GNU_VERSIONS = {"GPL": ("2", "3"), "LGPL": ("2", "2 1", "3"), "AGPL": ("3",)}
GNU_TERMS = "you can redistribute it and or modify it under the terms of the gnu {name} public license as published by the free software foundation {version}"
GNU_ENDS = (("later", "either version {} of the license or at your option any later version"), ("only", "version {} of the license"))
GNU_SUBJECTS = ("this program is free software", "this library is free software", "this file is free software")
CREATIVE_COMMONS = {
    "by": "attribution", "by sa": "attribution sharealike", "by nd": "attribution noderivatives", "by nc": "attribution noncommercial",
    "by nc sa": "attribution noncommercial sharealike", "by nc nd": "attribution noncommercial noderivatives",
}
CC_VERSIONS = ("2 0", "2 5", "3 0", "4 0")
#: Licences by the names that one-line notices give them.
NAMED = {
    "mit": "MIT", "isc": "ISC", "bsd": "BSD", "bsd 2 clause": "BSD-2-Clause", "2 clause bsd": "BSD-2-Clause", "simplified bsd": "BSD-2-Clause",
    "bsd 3 clause": "BSD-3-Clause", "3 clause bsd": "BSD-3-Clause", "new bsd": "BSD-3-Clause", "zlib": "Zlib", "boost software": "BSL-1.0",
    "apache": "Apache-2.0", "apache 2 0": "Apache-2.0", "mozilla public": "MPL-2.0", "eclipse public": "EPL-2.0",
    "gnu general public": "GPL", "gnu lesser general public": "LGPL", "gnu affero general public": "AGPL",
}
NOTICES = ("released under the {name} license", "licensed under the {name} license", "distributed under the {name} license", "this software is released under the {name} license", "this project is licensed under the {name} license")
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-title": "apache license version 2 0 january 2004 http www apache org licenses",
    "mit-title": "the mit license mit",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-use": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl-header": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "epl-1": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    "epl-2": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost-title": "boost software license version 1 0 august 17th 2003",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "rights": "all rights reserved",
    **{f"gnu-{i}": subject for i, subject in enumerate(GNU_SUBJECTS)},
}
# Rules in order: identifiers of successive known sentences, and the licence they stand for.
RULES = [
    (("apache-header", "apache-use", "apache-copy"), "Apache-2.0"), (("apache-header", "apache-use"), "Apache-2.0"), (("apache-header",), "Apache-2.0"), (("apache-notice",), "Apache-2.0"),
    (("apache-title",), "Apache-2.0"), (("mit-title", "mit-grant", "mit-notice"), "MIT"), (("mit-grant", "mit-notice"), "MIT"), (("mit-grant",), "MIT"), (("mit-notice",), "MIT"), (("mit-title",), "MIT"),
    (("isc-grant",), "ISC"), (("bsd-use", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"), (("bsd-use", "bsd-source", "bsd-binary"), "BSD-2-Clause"), (("bsd-use",), "BSD"),
    (("mpl-header", "mpl-copy"), "MPL-2.0"), (("mpl-header",), "MPL-2.0"), (("epl-1",), "EPL-1.0"), (("epl-2",), "EPL-2.0"), (("unlicense",), "Unlicense"), (("zlib-grant",), "Zlib"),
    (("boost-title",), "BSL-1.0"), (("cc0",), "CC0-1.0"), (("gnu-0", "gpl3-work"), "GPL-3.0"), (("gpl3-work",), "GPL-3.0"), (("gpl2-title",), "GPL-2.0"), (("gpl3-title",), "GPL-3.0"),
    (("lgpl21-title",), "LGPL-2.1"), (("lgpl3-title",), "LGPL-3.0"), (("agpl3-title",), "AGPL-3.0"), (("rights",), "proprietary"),
]


def _spelled(version: str) -> str:
    """A version as licences are named after it: `2 1` is 2.1, `3` is 3.0."""
    return version.replace(" ", ".") if " " in version else f"{version}.0"


def templates() -> tuple[dict[str, str], list[tuple[tuple[str, ...], str]]]:
    """Sentences (text to identifier) and rules that follow from names and versions.

    GNU headers come as one sentence, or cut after their subject, before their version, or both; `or later` and `only` are
    told apart in the identifier, not in the licence.
    """
    texts, rules = {}, []

    def add(identifier: str, text: str, licence: str, *before: str) -> None:
        texts[text] = identifier
        for first in (*((b,) for b in before), ()):
            if ((*first, identifier), licence) not in rules:
                rules.append(((*first, identifier), licence))

    for name, family in GNU.items():
        for version in GNU_VERSIONS[family]:
            licence = f"{family}-{_spelled(version)}"
            for kind, end in GNU_ENDS:
                terms, begin = GNU_TERMS.format(name=name, version=end.format(version)), GNU_TERMS.format(name=name, version="").strip()
                version_id = f"version-{_spelled(version)}-{kind}"
                texts[begin], texts[end.format(version)] = f"{family}-terms", version_id
                for subject in (*((f"gnu-{i}",) for i in range(len(GNU_SUBJECTS))), ()):
                    rules.append(((*subject, f"{family}-terms", version_id), licence))
                add(f"{licence}-{kind}", terms, licence, *(f"gnu-{i}" for i in range(len(GNU_SUBJECTS))))
                for subject in GNU_SUBJECTS:
                    texts[f"{subject} {begin}"] = f"{family}-terms"
                    add(f"{licence}-{kind}", f"{subject} {terms}", licence)
    for short, long in CREATIVE_COMMONS.items():
        for version in CC_VERSIONS:
            licence = f"CC-{short.upper().replace(' ', '-')}-{version.replace(' ', '.')}"
            scope = "international" if version == "4 0" else "unported" if version == "3 0" else "generic"
            for text in (f"licensed under cc {short} {version}", f"this work is licensed under cc {short} {version}", f"this work is licensed under a creative commons {long} {version} {scope} license", f"this work is licensed under the creative commons {long} {version} {scope} license"):
                add(licence, text, licence)
    for name, licence in NAMED.items():
        for notice in NOTICES:
            add(f"named-{licence}", notice.format(name=name), licence)
    return texts, rules


def defaults() -> tuple[dict[str, str], list[tuple[tuple[str, ...], str]]]:
    """All known sentences and ordered rules: those written out above, then the templates; longer sequences first."""
    texts, rules = templates()
    every = [*RULES, *rules]
    written = {text: name for name, text in SENTENCES.items()} | {"this source code form is subject to the terms of the mozilla public license v": "mpl-header"}
    return {**written, **texts}, sorted(every, key=lambda r: -len(r[0]))


def known_sequence(text: Column, sentences: Mapping[str, str]) -> Column:
    """The identifiers of the known sentences (text to identifier) of a text, each in angle brackets, in order."""
    names = F.create_map(*[F.lit(x) for sentence, name in sentences.items() for x in (sentence, f"<{name}>")])

    def known(sentence: Column) -> Column:
        return F.element_at(names, F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " ")))

    # A sentence is looked up whole first, over its line breaks and the marks of comments, else line by line.
    whole = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SENTENCE_CUTS)
    return F.array_join(F.transform(whole, lambda s: F.coalesce(known(s), F.array_join(F.transform(F.split(s, CUTS), known), ""))), "")


def scan(documents: DataFrame, sentences: Mapping[str, str] | None = None, rules: Sequence[tuple[Sequence[str], str]] | None = None) -> DataFrame:
    """doc_id, n_known, licences, licensed for every row of documents (doc_id, text).

    `sentences` map normalised sentences to identifiers of letters, digits, dots and hyphens; `rules` are sequences of
    identifiers with the licence they stand for, in order. licences names the licence of each rule matched, in text order,
    with repeats, comma-joined; known sentences that no rule takes count in n_known only. Null and empty texts have none.
    Repeated rows stay; other columns are left out.
    """
    known, ordered = defaults()
    sentences, rules = known if sentences is None else sentences, ordered if rules is None else rules
    spelled = {"".join(f"<{i}>" for i in ids): licence for ids, licence in reversed(list(rules))}
    seen = documents.select("doc_id", known_sequence(documents["text"], sentences).alias("sequence"))
    names = F.create_map(*[F.lit(x) for pair in spelled.items() for x in pair])
    pattern = "|".join("".join(f"<{i}>" for i in ids).replace(".", r"\.") for ids, _ in rules)
    matched = F.transform(F.regexp_extract_all("sequence", F.lit(f"({pattern})"), F.lit(1)), lambda m: F.element_at(names, m))
    out = seen.withColumn("licences", F.array_join(matched, ","))
    n_known = F.length(F.regexp_replace("sequence", "[^<]", "")).cast("bigint")
    return out.select("doc_id", n_known.alias("n_known"), "licences", (F.col("licences") != "").alias("licensed"))
