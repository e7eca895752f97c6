import re
from itertools import product
from re import _parser as parser

import pyarrow as pa

from gaugeworks.llm.licenses import FAMILIES, SENTENCES, Scanner, contained_out, license_labels, rules
from gaugeworks.llm.tokens import ALNUM, split
from tests.llm import cases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEXTS = [
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "cc\nBY cc by CC, by",
    "Released under the MIT License. Licensed under the Apache License, Version 2.0", "mit lizenz, apache", "SPDX-License-Identifier: LGPL-2.1-only",
    "gnu general public", "license apache", "émit license mit license", "CC BY-SA 3.0 and CC BY 4.0", "cc by " * 5000,
]


def plain(text):
    w = WORD.findall((text or "").translate(AZ))
    found = [(i, label) for p, label in BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_base_places_equal_plain_search(spark):
    rows = [cases.doc(i, t) for i, t in enumerate(TEXTS)] + cases.odd(100)
    got = license_labels(cases.with_extra(cases.frame(spark, rows))).collect()
    mine = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got]
    assert sorted(map(str, mine)) == sorted(str((r[0], *plain(r[1]))) for r in rows)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[0]["labels"] == "gpl,gpl-3.0" and by[1]["labels"] == "cc-by,cc-by-nc-4.0"
    assert by[5]["labels"] == "lgpl-2.1" and by[5]["score"] > 0.98
    assert by[9]["labels"] == "cc-by,cc-by-4.0,cc-by-sa-3.0"
    assert by[4]["labels"] == "" and by[4]["score"] == 0
    assert license_labels(cases.frame(spark, [])).collect() == []


def test_rules_are_hundreds_and_ordered():
    found = rules()
    # Written by hand: names with their versions, and sentences; forms of notice multiply the former.
    names = {(f[2], v) for f in FAMILIES for v in f[4].split(",")}
    assert len(names) + len({body for _, _, body in SENTENCES}) > 320
    assert [r.priority for r in found] == sorted((r.priority for r in found), reverse=True)


def test_containment():
    ranked = [(5, 9, "a", 1.0), (6, 8, "b", 1.0), (4, 9, "c", 1.0), (5, 9, "d", 1.0), (8, 12, "e", 1.0), (8, 9, "f", 1.0), (0, 4, "g", 1.0)]
    assert [x[2] for x in contained_out(ranked)] == ["a", "c", "e", "g"]


def spellings(pattern):
    """Every text that a name pattern takes."""

    def each(node):
        kind, value = str(node[0]), node[1]
        if kind == "LITERAL":
            return [chr(value)]
        if kind == "IN":
            return [chr(v) for _, v in value]
        if kind == "BRANCH":
            return [t for part in value[1] for t in whole(part)]
        if kind == "SUBPATTERN":
            return whole(value[-1])
        assert kind == "MAX_REPEAT" and tuple(value[:2]) == (0, 1)
        return ["", *whole(value[2])]

    def whole(nodes):
        return ["".join(t) for t in product(*map(each, nodes))]

    return whole(parser.parse(pattern))


def labels_of(spark, texts):
    return [r["labels"] for r in sorted(license_labels(cases.frame(spark, [cases.doc(i, t) for i, t in enumerate(texts)])).collect())]


def test_british_and_joined_spellings(spark):
    texts = ["MIT licence", "Mozilla Public Licence 2.0", "GNU General Public Licence v3", "the FreeBSD License", "under the FreeBSD Licence"]
    assert labels_of(spark, texts) == ["mit", "mpl-2.0", "gpl-3.0", "bsd-2-clause", "bsd-2-clause"]


def test_gates_lose_nothing():
    scanner = Scanner()
    forms = ("{}", "licensed under the {}", "terms of the {}", "see {}", "spdx license identifier {}")
    names = sorted({t for f in FAMILIES for t in spellings(f[2])} | {f[3] for f in FAMILIES})
    texts = [f.format(n) for n in names for f in forms]
    words = split(pa.array(texts), ALNUM)
    present, every = scanner.gates(words, words.hashes()), {w for r in scanner.rules for w in r.gate}
    for d, text in enumerate(texts):
        assert scanner.detect(words, d, present.get(d, set())) == scanner.detect(words, d, every), text


def test_license_texts_without_a_name(spark):
    texts = [
        "/* Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files (the \"Software\") */",
        "# Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "The origin of this software must not be misrepresented; you must not claim", "free of charge, in source and binary forms",
    ]
    assert labels_of(spark, texts) == ["mit", "bsd-style", "isc-style", "zlib", ""]


def test_gates_of_sentences():
    scanner = Scanner()
    by = {r.pattern.pattern: r for r in scanner.rules}
    for _, gate, body in SENTENCES:  # every gate word is in every way to write the sentence
        rule = by[f"(?<= ){body}(?= )".encode()]
        plain = re.sub(r"\(\?: \[\^ \]\+\)\{\d+,\d+\}", " of", body).replace("[0-9]+", "2")
        for text in spellings(plain):
            words = split(pa.array([text]), ALNUM)
            assert scanner.gates(words, words.hashes())[0] >= set(rule.gate) and rule.pattern.search(f" {text} ".encode()), (text, gate)


def test_bodies_headers_and_notices(spark):
    texts = {
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE.""": {"gpl", "gpl-2.0-or-later", "gpl-style"},
        """ * Unless required by applicable law or agreed to in writing, software distributed under the License is
        * distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        * See the License for the specific language governing permissions and limitations under the License.""": {"apache-2.0"},
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""": {"mpl-2.0"},
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""": {"bsd-3-clause"},
        """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
        TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""": {"mit"},
        "You must give appropriate credit, provide a link to the license, and indicate if changes were made.": {"cc-by"},
        "The author disclaims copyright to this source code. In place of a legal notice, here is a blessing:": {"sqlite-blessing"},
        "This software is based in part on the work of the Independent JPEG Group.": {"ijg"},
        "You may not reverse engineer, decompile, or disassemble the Software.": {"proprietary"},
        "The license of the source is in the file; the work may be used with permission of its authors.": set(),
    }
    got = labels_of(spark, list(texts))
    assert [set(filter(None, g.split(","))) for g in got] == list(texts.values())
