from __future__ import annotations

import random
import re

from salesloom.llm import common, licenses

WORDS = re.compile(licenses.WORD)


def base(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES:
        parts = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(parts)] == parts:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels)


def scan(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, labels string")
    return {r["doc_id"]: r for r in licenses.scanned(frame).collect()}


def test_base_places_equal_plain_python(spark):
    common.prepared(spark)
    chance = random.Random(8)
    parts = ["cc", "by", "CC-BY", "all rights", "reserved", "General", "public", "license", "é", "x,", "\n", "All rights reserved.", "cc by", "4.0", "_", "ccby", "Éall"]
    rows = [(k, " ".join(chance.choice(parts) for _ in range(chance.randint(0, 25))), "x") for k in range(400)]
    rows += [(900, None, "x"), (901, "", "x"), (902, "cc by cc by", "x"), (903, "all rights reserved", "x")]
    found = scan(spark, rows)
    for i, text, _ in rows:
        r = found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base"]) == base(text), text
        assert set(r["base"]) <= set(r["labels"])


def test_rules_priorities_and_containment(spark):
    common.prepared(spark)
    rows = [
        (1, "Licensed under the Apache License, Version 2.0.", None),
        (2, "This work is licensed under the GNU General Public License, version 3.", None),
        (3, "Licensed under CC BY-NC 4.0.", None),
        (4, "Released under the MIT License.", None),
        (5, "BSD 3-Clause License and the Mozilla Public License 2.0", None),
        (6, "Permission is hereby granted, free of charge, to any person obtaining a copy", None),
        (7, "he licensed nothing", None),
        (8, "under the GPL, and again GPL, then LGPL 2.1", None),
    ]
    found = {i: r["labels"] for i, r in scan(spark, rows).items()}
    assert found[1] == ["apache-2.0"]
    assert found[2] == ["gpl", "gpl-3"]
    assert found[3] == ["cc-by", "cc-by-nc-4.0"]
    assert found[4] == ["mit"]
    assert found[5] == ["bsd-3-clause", "mpl-2.0"]
    assert found[6] == ["mit"]
    assert found[7] == []
    assert found[8] == ["gpl", "lgpl-2.1"]


def test_identifiers_behind_the_spdx_mark_and_bare_versions(spark):
    common.prepared(spark)
    cases = {
        "SPDX-License-Identifier: Apache-2.0": ["apache-2.0"],
        "SPDX-License-Identifier: MIT": ["mit"],
        "// SPDX-License-Identifier: MIT OR Apache-2.0 */": ["apache-2.0", "mit", "spdx"],
        "SPDX-License-Identifier: GPL-2.0-only": ["gpl-2.0", "spdx"],
        "SPDX-License-Identifier: BSL-1.0 int main": ["bsl-1.0", "spdx"],
        "SPDX-License-Identifier: MS-PL": ["ms-pl"],
        "SPDX-License-Identifier: ISC OR Zlib OR Apache-2.0 OR BSD-3-Clause": ["apache-2.0", "bsd-3-clause", "isc", "spdx", "zlib"],
        "SPDX-License-Identifier: LicenseRef-own": ["spdx"],
        "under Apache 2.0": ["apache-2.0"],
        "Apache v2.0 is fine": ["apache-2.0"],
        "Apache version 2.0": ["apache-2.0"],
        "the server Apache 2.0.52 runs": [],
        "mit apache zlib": [],
    }
    found = scan(spark, [(k, text, None) for k, text in enumerate(cases)])
    got = {text: [x for x in found[k]["labels"] if not x.startswith("unknown")] for k, text in enumerate(cases)}
    assert got == cases


def test_all_matches_have_their_places(spark):
    common.prepared(spark)
    frame = spark.createDataFrame([(1, "MIT license, a MIT license b mit license")], "doc_id bigint, text string")
    found = licenses.detections(licenses.prepared_texts(frame)).filter("label = 'mit' and tier = 2").collect()
    assert sorted((r["start"], r["end"]) for r in found) == [(0, 2), (3, 5), (6, 8)]


def test_rule_table():
    rules = licenses._family_rules()
    assert len(rules) > 200
    for _, _, keyword, pattern in rules:
        assert re.fullmatch("[a-z0-9]+", keyword)
        re.compile(pattern)


def test_repeated_rows_nulls_and_empty_table(spark):
    common.prepared(spark)
    rows = [(1, "MIT license", "a"), (1, "MIT license", "a"), (None, "mit license", "b"), (2, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    found = licenses.scanned(frame).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["labels"]) for r in found) == [
        ("1", 2, ["mit"]), ("1", 2, ["mit"]), ("2", 0, []), ("None", 2, ["mit"])]
    assert all(0 <= r["confidence"] <= 1 for r in found)
    assert licenses.scanned(frame.limit(0)).count() == 0
