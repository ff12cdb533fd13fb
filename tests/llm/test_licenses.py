import random
import re
import time

import pytest

from eventwatch.llm import licenses, queries
from eventwatch.llm.common import words
from fixtures import empty, frame, rows


@pytest.mark.parametrize("text, labels", [
    ("Released under the MIT License.", ["mit"]),
    ("licensed under the GNU General Public License, version 3", ["gpl-3.0"]),
    ("GPL v2 or any later version", ["gpl-2.0-or-later"]),
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"]),
    ("SPDX-License-Identifier: Apache License 2.0", ["apache-2.0"]),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", ["bsd"]),
    ("we commit to the mission, a summit of apaches", []),
    ("", []),
])
def test_labels(text, labels):
    assert sorted({d[0] for d in licenses.scan(text.encode())[1]}) == labels


def test_hundreds_of_rules_each_with_its_keyword():
    rules = licenses.rules()
    assert len(rules) > 200 and len({r.name for r in rules}) == len(rules)
    assert [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)


@pytest.mark.parametrize("tag, label", [
    ("MIT", "mit"), ("ISC", "isc"), ("Zlib", "zlib"), ("Artistic-2.0", "artistic-2.0"), ("BSL-1.0", "bsl-1.0"), ("PostgreSQL", "postgresql"),
    ("NCSA", "ncsa"), ("OpenSSL", "openssl"), ("MS-PL", "ms-pl"), ("OSL-3.0", "osl-3.0"), ("AFL-3.0", "afl-3.0"), ("SSPL-1.0", "sspl-1.0"),
    ("BUSL-1.1", "busl-1.1"), ("W3C", "w3c"), ("JSON", "json"), ("curl", "curl"), ("Apache-2.0", "apache-2.0"), ("BSD-3-Clause", "bsd-3-clause"),
    ("GPL-2.0-or-later", "gpl-2.0-or-later"), ("LGPL-2.1-only", "lgpl-2.1"), ("CC-BY-SA-4.0", "cc-by-sa-4.0"), ("CC0-1.0", "cc0-1.0")])
def test_spdx_tags(tag, label):
    found = licenses.scan(f"x SPDX-License-Identifier: {tag}\n\nimport os".encode())[1]
    assert [(d[0], d[2], d[4]) for d in found] == [(label, 1, 1.0)]


def examples(parsed):
    """Texts of a pattern's branches: each alternative once, beside the first of all others."""
    parts = []
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            parts.append([chr(arg)])
        elif op == "ANY":
            parts.append(["x"])
        elif op == "IN":
            parts.append([c for k, v in arg for c in (["2"] if str(k) == "RANGE" else [chr(v)])])
        elif op == "BRANCH":
            parts.append([e for b in arg[1] for e in examples(b)])
        elif op == "SUBPATTERN":
            parts.append(examples(arg[3]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            parts.append(["" if arg[0] == 0 else examples(arg[2])[0] * arg[0], *examples(arg[2])])
        else:
            assert op == "ASSERT"  # what has to follow
            parts.append(examples(arg[1]))
    first = [p[0] for p in parts]
    return ["".join(first)] + ["".join([*first[:i], e, *first[i + 1:]]) for i, p in enumerate(parts) for e in p[1:]]


def test_no_rule_is_dead_and_keywords_drop_no_match():
    for rule in licenses.rules():
        lines = [x.encode() for x in examples(re._parser.parse(rule.pattern.pattern.decode()))]
        matched = [x for x in lines if rule.pattern.search(x)]
        assert matched, rule.name
        for x in matched:
            assert rule.keyword in x, (rule.name, x)
            assert licenses.scan(x)[1], (rule.name, x)


@pytest.mark.parametrize("text, label", [("may not be copied without prior written permission", "proprietary"), ("Apache 2.0", "apache-2.0"), ("GNU GPL", "gpl")])
def test_gated_and_shadowed_cases(text, label):
    assert [(d[0], d[2]) for d in licenses.scan(text.encode())[1]] == [(label, 0)]


def test_contained_detections_are_suppressed_and_none_overlap_inside():
    text = "Licensed under CC BY-SA 4.0. cc by cc by cc. Apache License, Version 2.0 or MIT license; all rights reserved " * 3
    n, found, base = licenses.scan(text.encode())
    assert n == len(words(text.encode()))
    assert not any(a is not b and a[2] <= b[2] and b[3] <= a[3] for a in found for b in found)
    assert all(0 <= a < b <= n and 0 <= s <= 1 for _, _, a, b, s in found)


def plain_scan(text):
    """Detections by every rule at every place, without keywords, and suppression by comparing all pairs."""
    ws = words(text)
    line = b" " + b" ".join(ws) + b" "
    raw = [(order, at, m.end(), rule, licenses._label(rule, m)) for order, rule in enumerate(licenses.rules())
           for at in range(len(line)) if (m := rule.pattern.match(line, at))]
    kept = []
    for _, a, b, rule, label in sorted(raw, key=lambda r: (-r[3].priority, r[1] - r[2], r[1], r[0])):
        if not any(x <= a and b <= y for x, y, _, _ in kept):
            kept.append((a, b, rule, label))
    return sorted((label, rule.name, line.count(b" ", 0, a), line.count(b" ", 0, b), rule.score) for a, b, rule, label in kept)


PARTS = ["licensed under the", "gnu general public license", "version 2", "or any later version", "cc by nc sa 4 0", "cc by", "apache license",
         "version 2 0", "mit license", "all rights reserved", "spdx license identifier mit", "bsd 3 clause", "lesser general public license", "and", "x"]


def test_detections_and_labels_equal_a_plain_scan(spark):
    sf = "/root/testdata/sf0.001"
    rnd = random.Random(5)
    texts = [" ".join(rnd.choices(PARTS, k=rnd.randint(1, 25))) for _ in range(25)]
    texts += [r.text[:3000] for r in spark.read.parquet(f"{sf}/documents.parquet").where("text rlike '(?i)licen[sc]e|copyright|cc by'").collect()[:15]]
    assert any(len(licenses.scan(t.encode())[1]) > 5 for t in texts)
    for t in texts:
        assert licenses.scan(t.encode())[1] == plain_scan(t.encode())


def test_cover_equals_all_pairs():
    rnd = random.Random(1)
    for _ in range(300):
        cover, taken = licenses.Cover(), []
        for _ in range(40):
            a = rnd.randint(0, 20)
            b = a + rnd.randint(1, 8)
            free = not any(x <= a and b <= y for x, y in taken)
            assert cover.add(a, b) == free
            if free:
                taken.append((a, b))


def test_long_text_of_license_phrases_in_linear_time():
    def seconds(n):
        text = " ".join(PARTS * n).encode()
        start = time.process_time()
        assert len(licenses.scan(text)[1]) >= 5 * n
        return time.process_time() - start
    seconds(10)
    assert seconds(4000) < 14 * max(seconds(500), 0.05)   # eight times the text; quadratic would be 64 times


def test_a_clashing_column_stays(spark):
    df = frame(spark).withColumnRenamed("Text_", "Licenses")
    assert licenses.with_licenses(df).columns == [*df.columns, "licenses_"]


def brute(text):
    ws = words((text or "").encode())
    places = [(label, i) for p, label in licenses.BASE.items() for i in range(len(ws)) if ws[i:i + len(p.split())] == p.encode().split()]
    return len(ws), len(places), min((i for _, i in places), default=None), max((i for _, i in places), default=None), ",".join(sorted({x for x, _ in places}))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    got = queries.op8_licenses(spark, sf).collect()
    assert len(got) == len(texts) and sum(r.n_base for r in got) > 20
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(","))))) and 0 <= r.score <= 1


def test_odd_rows(spark):
    got = licenses.with_licenses(frame(spark)).collect()
    assert len(got) == len(rows()) and all(r.licenses.n_words == len(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").encode().lower())) for r in got)
    assert licenses.with_licenses(empty(spark)).count() == 0
