import re

from pyspark.sql import functions as F

from terrabrook.llm import licenses as L

TEXTS = [
    None, "", "nothing here", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: BSD-3-Clause\nfoo", "CC BY and cc-by-sa 4.0, CC  BY", "gnu general public license gnu general public license", "the gnu lesser general public license v2.1 or later", "mit license " * 300,
    "dual-licensed under the  *  MIT license or the Mozilla Public License 2.0", "ÄPACHE LICENSE apache-license Apache 2 license😀mit license", "released under cc0 1.0 universal; public domain dedication", "a permit licence; admit licenses", "cc", "by cc by",
]


WORDS = re.compile("[0-9a-z\u0080-\U0010ffff]+")


def brute(text):
    """Every rule runs over every text: no gate, no keywords."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(low)
    places, base = [], set()
    for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")):
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    every = [(m.start(), -m.end(), rule, label) for rule, label, _, pattern in L.rules() for m in re.finditer(pattern, low, re.A)]
    kept = [d for d in every if not any(o != d and o[0] <= d[0] and -o[1] >= -d[1] and (o[:2] != d[:2] or o < d) for o in every)] if len(every) < 400 else None
    return len(words), sorted(places), sorted(base), kept


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, words string")
    for r in L.scan_licenses(df).collect():
        n, places, base, kept = brute(TEXTS[r.doc_id])
        assert (r.n_words, sorted(r.places), r.base_labels) == (n, places, base), r.doc_id
        if kept is not None:
            assert [(d.start, -d.end, d.rule, d.label) for d in r.found] == sorted(kept), r.doc_id
            if "SPDX" not in (TEXTS[r.doc_id] or ""):
                assert r.labels == sorted(set(base) | {d[3] for d in kept})
        assert 0 <= r.score <= 1
    assert L.scan_licenses(df.filter(F.lit(False))).collect() == []


def sample(pattern, space=" "):
    """A short string that the pattern matches."""
    from re import _constants as c
    from re import _parser

    def text(tree):
        out = ""
        for op, arg in tree:
            if op is c.LITERAL:
                out += chr(arg)
            elif op is c.IN:
                first = next((x for x in arg if x[0] in (c.LITERAL, c.RANGE)), None)
                spaces = any(x[0] is c.CATEGORY for x in arg)
                out += space if spaces else chr(first[1] if first[0] is c.LITERAL else first[1][0])
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
                out += text(arg[2]) * max(arg[0], 0)
            elif op is c.SUBPATTERN:
                out += text(arg[3])
            elif op is c.BRANCH:
                out += text(arg[1][0])
            elif op is c.ANY:
                out += "x"
            else:
                assert op in (c.ASSERT, c.ASSERT_NOT), op
        return out

    return text(_parser.parse(pattern))


def test_every_rule_is_reached(spark):
    """A minimal match of each rule, on one line and broken over comment lines, passes the gate and the rule's keyword."""
    rows = [(2 * rule + k, sample(pattern, space).upper()) for rule, _, _, pattern in L.rules() for k, space in enumerate((" ", "\n * "))]
    assert len(L.rules()) > 200
    for i, text in rows:
        assert re.search(L.rules()[i // 2][3], text.lower(), re.A), text
    for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        kept = brute(dict(rows)[r.doc_id])[3]
        assert [(d.start, -d.end, d.rule, d.label) for d in r.found] == sorted(kept), r.doc_id
        rule = L.rules()[r.doc_id // 2]
        assert rule[1] in r.labels or any(d.start == 0 and d.rule != rule[0] for d in r.found), (rule, r.labels)


def test_texts_without_a_name(spark):
    texts = {
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, express or implied': ["mit"],
        "# Redistribution and use in source and binary forms, with or\n# without modification, are permitted": ["bsd"],
        "Neither the name of Acme Inc. nor the names of its contributors may be used to endorse or promote products": ["bsd-3-clause"],
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;": ["gpl"],
        "see https://creativecommons.org/licenses/by-sa/4.0/ and http://www.apache.org/licenses/LICENSE-2.0": ["apache", "cc-by-sa"],
        "Copyright (c) 2019-2021 Some One. All rights reserved": ["proprietary"],
        "A warranty is a promise; permission to park; our domain is example.org, and commercial notice of a grant": [],
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in L.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_weights(spark):
    texts = {"licensed under the MIT License": 0.95, "Mozilla Public License, version 2.0": 0.8, "the Zlib license": 0.6, "This library is free software; you can redistribute it and/or modify it": 0.9}
    got = {r.doc_id: r.score for r in L.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_very_long_text_and_repeated_rows(spark):
    text = "plain words of a page \n" * 20_000 + "Licensed under the ISC License. " + "more words " * 20_000
    rows = L.scan_licenses(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")).collect()
    assert [(r.n_words, r.labels) for r in rows] == [(20_000 * 5 + 5 + 40_000, ["isc"])] * 2
    assert rows[0].found[0].start == len("plain words of a page \n") * 20_000


def test_found_licenses(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    labels = {r.doc_id: r.labels for r in L.scan_licenses(df).collect()}
    assert labels[6] == ["bsd-3-clause"] and labels[9] == ["lgpl"] and labels[11] == ["mit", "mpl"] and labels[2] == [] and labels[14] == []


def test_broken_names_and_expressions(spark):
    texts = {
        "under the GNU Lesser\n * General Public License": ["lgpl"], "Creative\nCommons Attribution": ["cc-by"], "dedicated to the public\n# domain": ["public-domain"], "the SIL Open\n// Font License": ["ofl"],
        "the Common   Public License": ["cpl"], "see the PSF license": ["python"], "see the Python\n * license": ["python"], "CC\n * BY-SA": ["cc-by", "cc-by-sa"], "_GPL": ["gpl"],
        "SPDX-License-Identifier: MIT OR Apache-2.0": ["apache", "mit"], "SPDX-License-Identifier: (Zlib AND (ISC OR GPL-2.0-only WITH Classpath-exception-2.0)) ruby": ["gpl", "isc", "zlib"],
        "SPDX-License-Identifier: MIT\nor ruby": ["mit"],
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in L.scan_licenses(df).collect()}
    assert [got[i][0] for i in range(len(texts))] == list(texts.values())
    assert got[10][1] == 1.0


#: Hand-written notices, none of them taken from the rules, with the label each should have.
NOTICES = """mit|License: MIT
mit|Licence MIT
mit|Licensed under the MIT
mit|"license": "MIT"
mit|This package is MIT-licensed, see the file LICENSE.
mit|Released under the MIT License (Expat).
mit|license = "MIT"
mit|You may use it under the terms of the MIT licence.
mit|The license is MIT.
mit|MIT licensed
apache|Apache 2.0
apache|License: Apache-2.0
apache|Licensed under Apache 2.0, see NOTICE.
apache|Licensed under the Apache License, Version 2.0 (the "License")
apache|This code is Apache licensed.
apache|"license": "Apache-2.0"
apache|Available under the Apache Software License 2.0
apache|License :: Apache v2
apache|apache-2.0
bsd-3-clause|BSD-3-Clause
bsd-3-clause|License: 3-clause BSD
bsd-3-clause|three-clause BSD
bsd-3-clause|Distributed under the BSD 3-Clause License
bsd-3-clause|Licensed under the New BSD
bsd-2-clause|bsd-2-clause
bsd-2-clause|the simplified BSD license applies
bsd-2-clause|License: BSD 2-clause
bsd|License: BSD
bsd|BSD-licensed
bsd|released under a BSD-style licence
gpl|GPLv3
gpl|License: GPL-2.0-or-later
gpl|under the terms of the GNU GPL
gpl|Licensed under GPL v2
gpl|GNU General Public Licence version 3
lgpl|LGPL-2.1
lgpl|This library is under the GNU Lesser General Public License.
agpl|AGPL-3.0-only
agpl|GNU Affero General Public License v3.0
isc|License: ISC
isc|Licensed under the ISC licence
mpl|MPL-2.0
mpl|License: MPL 2.0
mpl|Mozilla Public License, v. 2.0
epl|EPL-2.0
epl|Eclipse Public License 1.0
zlib|license: zlib
boost|Boost Software License 1.0
unlicense|This is free and unencumbered software released into the public domain.
unlicense|License: Unlicense
cc0|CC0-1.0
cc0|CC0 1.0 Universal
cc-by|CC BY 4.0
cc-by-sa|Text is available under CC BY-SA 3.0
cc-by-nc|licensed under CC-BY-NC 4.0
cc-by-sa|Creative Commons Attribution-ShareAlike 4.0 International
wtfpl|WTFPL
public-domain|License: public domain
ofl|Fonts are licensed under the SIL Open Font License 1.1
ofl|License: OFL 1.1
postgresql|License: PostgreSQL
python|License: PSF
artistic|Artistic License 2.0
0bsd|0BSD
proprietary|License: proprietary
proprietary|Copyright 2020 Foo Ltd. All rights reserved.
eupl|EUPL 1.2
cddl|Common Development and Distribution License (CDDL)
odbl|Open Database License (ODbL)""".splitlines()
STRANGERS = [
    "Wir fahren mit dem Bus und mit der Bahn.", "The license plate was bent.", "He holds a fishing licence, mit or without a boat.", "Apache pilots flew low over the valley.", "The server runs Apache 2.4 on port 80.", "apache 2.0.54 was slow",
    "A boost of the licence fee", "She reads the Epl table", "BSD systems are fast", "the permit is open", "Die Lizenz mit Auflagen", "isc and zlib are words here", "The driving license is valid for ten years", "Python is a snake and a language",
]


def test_recall_on_hand_written_notices(spark):
    rows = [(i, *x.split("|", 1)) for i, x in enumerate(NOTICES)]
    got = {r.doc_id: r.labels for r in L.scan_licenses(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")).collect()}
    missed = [(label, t, got[i]) for i, label, t in rows if label not in got[i]]
    assert len(missed) <= 0.05 * len(rows), missed
    strangers = L.scan_licenses(spark.createDataFrame(list(enumerate(STRANGERS)), "doc_id long, text string")).collect()
    assert [(STRANGERS[r.doc_id], r.labels) for r in strangers if r.labels] == []
