"""Operators 2, 3, 9 and 10, and the odd cases their docstrings define."""

import hashlib

import brute
import pytest
from oracle import compare

from tidemark.llm import decontamination
from tidemark.llm.decontamination import contained_items, decontaminated
from tidemark.llm.license_scan import SENTENCES, identifier, identifiers, matched, scan_licenses
from tidemark.llm.queries import QUERIES, SQL
from tidemark.llm.secret_scan import base_spans, redacted, scan_secrets
from tidemark.llm.toxicity import labelled, scored, trained

HEX = "0123456789abcdef" * 2
LIVE = "q9Zr4TmX7kLw2PvB8nJc5YhD"


def test_base_spans_follow_the_patterns():
    text = f'é API_KEY: "abcd1234" x {HEX} AKIA{"Z" * 12} AKIASHORT pass{HEX[:31]} password="secret" : "abcdefghi" ſecret=abcdefgh1'
    found = [(text[s:e], rank) for s, rank, e, _ in base_spans(text)]
    assert found == [('API_KEY: "abcd1234', 0), (HEX, 2), ("AKIA" + "Z" * 12, 1)]
    assert base_spans("token=" + HEX) == [(0, 0, 38, HEX), (6, 2, 38, HEX)]


def test_secrets_by_ownership(spark):
    rows = [(i, f"s{i % 7}", f"see token: copied-Example-0123456789-abc {'.' * i}") for i in range(21)]
    rows += [(100, "s1", f"run with {LIVE} now, {HEX}"), (101, "s1", f"run with {LIVE} again")]
    rows += [(200 + i, f"s{i}", "all use W8cQ2xV6bN4mK1jH7gF5dS3a too") for i in range(6)]
    rows += [(300, None, None), (301, "s1", ""), (None, "s2", f"token={HEX}"), (100, "s1", f"run with {LIVE} now, {HEX}")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = scan_secrets(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert (by[3].n_assign, by[3].n_live, by[3].n_copied) == (1, 0, 1)
    assert by[100].spans == "live:9:33,hex:39:71" and by[100].n_live == 2 and by[101].spans == "live:9:33"
    assert by[200].spans == ""  # six owners: an example, and no base kind
    assert by[100].base_sha256 == hashlib.sha256(b"hex:39:71").hexdigest()
    assert by[300].base_sha256 == by[301].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None].spans == "assign:0:38,hex:6:38"
    assert scan_secrets(docs.limit(0)).count() == 0


def test_redaction_cuts_live_secrets_only(spark):
    rows = [(1, "a", f"é key {LIVE} end", 30, 9), (2, "a", "nothing here", 12, 9), (3, "a", None, 0, 9), (None, "b", f"token={HEX}!", 39, 9)]
    rows += [(10 + i, f"s{i}", "token=widely-copied-example", 27, 9) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, n_chars int, live int")
    out = redacted(docs)
    assert out.schema == docs.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[1] == ("é key [SECRET] end", 18) and got[None] == ("[SECRET]!", 9)
    assert got[2] == ("nothing here", 12) and got[3] == (None, 0) and got[11][0] == "token=widely-copied-example"


def test_licence_sentences_and_rules():
    assert identifier("# Licensed under the Apache License,\n# Version 2.0.") == "=Apache-2.0"
    assert identifier("This work is licensed under the GNU General Public License, version 3") == "=GPL-3.0"
    assert identifier("SPDX-License-Identifier: BSD-3-Clause") == "=BSD-3-Clause"
    assert identifier("Licensed under my own terms") is None and identifier("A clean sentence") is None
    notice = ["permission_any", "notice_included", "as_is_software", "no_liability_authors"]
    text = "// Copyright 2020 A. Person.\n" + "\n".join("// " + SENTENCES[n] + "." for n in notice)
    assert [n for n, _, _ in matched(identifiers(text))] == ["MIT"]
    text = "\n".join(f"{i}. {SENTENCES[n]}." for i, n in enumerate(["redistribution", "source_retains", "binary_reproduces", "no_endorsement"]))
    assert [n for n, _, _ in matched(identifiers(text))] == ["BSD-3-Clause"]
    cut = SENTENCES["redistribution"] + ". " + "Other words. " * 4 + SENTENCES["source_retains"] + "."
    assert [n for n, _, _ in matched(identifiers(cut))] == ["incomplete", "incomplete"]


STANDARD = {
    "GPL-3.0-or-later": "# Copyright (C) 2020 A. Person\n#\n# This program is free software: you can redistribute it and/or modify\n"
    "# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of "
    "the License, or\n# (at your option) any later version.\n#\n# This program is distributed in the hope that it will be useful.",
    "MPL-2.0": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was "
    "not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance '
    "with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required",
}


def test_every_rule_fires_on_its_own_text():
    from tidemark.llm.license_scan import RULES

    for licence, names in RULES:
        text = "\n\n".join(SENTENCES[n] + "." for n in names)
        assert [n for n, _, _ in matched(identifiers(text))] == [licence], names
    for licence, text in STANDARD.items():
        assert [n for n, _, _ in matched(identifiers(text))] == [licence]
    assert [n for _, _, _, n in identifiers(STANDARD["Apache-2.0"])] == ["apache_2", "apache_copy"]


@pytest.mark.parametrize(
    ("text", "licences"),
    [
        ("Licensed under the GPLv3.", ["GPL-3.0"]),
        ("Distributed under the terms of the GNU General Public License v3.0.", ["GPL-3.0"]),
        ("Distributed under the GNU GPL version 2\nor (at your option) any later version.", ["GPL-2.0-or-later"]),
        ("// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", ["GPL-2.0-or-later"]),
        ("# SPDX-License-Identifier: LGPL-2.1-only", ["LGPL-2.1-only"]),
        ("SPDX-License-Identifier: Apache-2.0 OR MIT\n", ["Apache-2.0", "MIT"]),
        ("SPDX-License-Identifier: (MIT AND BSD-3-Clause)", ["BSD-3-Clause", "MIT"]),
        ("Released under the MIT License, see LICENSE for details.", ["MIT"]),
        ("Released under MIT (see LICENSE).", ["MIT"]),
        ("This file is licensed under the Mozilla Public License, v. 2.0.", ["MPL-2.0"]),
        ("Released under MIT\nDocs are free. This text is licensed under CC BY-SA 4.0 International", ["MIT", "CC-BY-SA-4.0"]),
        ("You may use this software under the MIT license.", ["MIT"]),
        ("It is licensed under Apache 2.0.", ["Apache-2.0"]),
        ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", ["Apache-2.0", "MIT"]),
        ("Distributed\nunder\nthe\nterms\nof the\nGNU General\nPublic License\nversion 3", ["GPL-3.0"]),
        ("Released under the MIT" + ", or not" * 50, ["MIT"]),
        ("The programs are available under MIT supervision, licensed under the Apache License 1.1.", []),
    ],
)
def test_statements_as_they_are_written(text, licences):
    assert [n for n, _, _ in matched(identifiers(text + " licence"))] == licences


def test_licence_texts_that_name_an_organisation():
    parts = ["redistribution", "source_retains", "binary_reproduces", "no_endorsement"]
    for one, two in [("the University", "its"), ("Example Widgets and Co", "the"), ("the copyright holder", "its")]:
        text = "\n\n".join(SENTENCES[n].replace("{name}", one, 1).replace("{name}", two) + "." for n in parts)
        assert [n for n, _, _ in matched(identifiers(text))] == ["BSD-3-Clause"]
    text = "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, " \
        "provided that the above\ncopyright notice and this permission notice appear in all copies."
    assert [n for n, _, _ in matched(identifiers(text))] == ["ISC"]


@pytest.mark.parametrize(
    "text",
    [
        "the licence, " * 80_000,
        "the\n" * 60_000 + "licence",
        "This software is licensed under my own, " + "odd, " * 200_000,
        "Licensed under " + ",,,, ;" * 170_000,
    ],
)
def test_texts_of_a_megabyte_take_linear_time(text):
    import time

    began = time.perf_counter()
    assert identifiers(text) == []
    assert time.perf_counter() - began < 10


def test_the_hint_passes_all_that_the_rules_accept(monkeypatch):
    import re

    from tidemark.llm import license_scan

    names = ["CC BY-SA 4.0", "Apache 2.0", "GPL 3", "zlib", "the terms of the MIT"]
    opens = ["This text is available", "Published", "This project is\ndistributed", "made available", "DUAL LICENSED"]
    texts = [f"{o} {u} {n}." for o in opens for u in ("under", "_under_", "UNDER\n#") for n in names] + [f"SPDX-License-Identifier: {n}" for n in names[:4]]
    texts += [wrap for s in SENTENCES.values() for wrap in (s, s.lower(), s.upper(), s.replace(" ", "\n# "))]
    hinted = [identifiers(t) for t in texts]
    monkeypatch.setattr(license_scan, "_HINT", re.compile(""))
    assert hinted == [identifiers(t) for t in texts] and all(hinted)


def test_licences_of_documents(spark):
    line = "Released under the MIT License."
    rows = [(1, f"prose here\n{line}\nmore. {line}"), (2, "a license to speak freely."), (3, None), (4, ""), (None, line)]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].licenses == "MIT" and got[1].n_licenses == 2 and got[1].spans == "MIT:11:41,MIT:49:79"
    assert got[None].licenses == "MIT" and all(got[i].spans == "" for i in (2, 3, 4))


@pytest.mark.parametrize("broadcast", [True, False])
def test_containment_matches_brute_force(spark, prose, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    items = {i: prose(15 + 3 * i, 50 + i) for i in range(12)} | {90: None, 91: "", 92: "only three words", 93: prose(15, 50)}
    docs = {i: prose(20 + 40 * i, i) for i in range(30)}
    for i in range(12):
        words = items[i].split(" ")
        docs[100 + i] = prose(900, 200 + i) + ", " + items[i].upper() + "; " + prose(30, 300 + i)
        docs[200 + i] = prose(50, 400 + i) + " " + " ".join(words[: len(words) - 2]) + " " + prose(300, 500 + i)
        docs[300 + i] = " ".join(words[: len(words) // 2]) + " " + prose(100, 600 + i)
    docs |= {400: None, 401: "", 402: "only three words", 403: items[3]}
    d = spark.createDataFrame([(i, t, 1) for i, t in docs.items()] + [(None, items[1], 1), (100, docs[100], 1)], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(list(items.items()) + [(None, items[2]), (2, items[2])], "item_id long, text string")
    expected = brute.contained(docs, items)
    got = {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in contained_items(d.repartition(4), b).collect()}
    assert got == expected and len(got) > 24
    if broadcast:
        left = decontaminated(d, b)
        assert left.columns == d.columns
        assert {r.doc_id for r in left.collect()} == ({*docs} - {i for i, _ in expected}) | {None}
        assert contained_items(d.limit(0), b).count() == contained_items(d, b.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_short_items_in_full_documents_match_the_sql(spark, prose, monkeypatch, tmp_path, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    items = {10 * n + k: prose(n, 7000 + 10 * n + k) for n in range(5, 16) for k in range(10)}
    docs = {}
    for item, text in items.items():
        for size in (16, 64, 256):  # shingles: as many as the partition takes
            rest = prose(size + 4 - len(text.split(" ")), 9000 + 1000 * size + item).split(" ")
            at = item % (len(rest) + 1)
            docs[1000 * size + item] = " ".join([*rest[:at], text, *rest[at:]])
    spark.createDataFrame(list(docs.items()), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    spark.createDataFrame(list(items.items()), "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "b"))
    for folder, name in (("d", "documents"), ("b", "benchmark")):
        next((tmp_path / folder).glob("*.parquet")).rename(tmp_path / f"{name}.parquet")
    name = "op9_benchmark_decontamination"
    rows, wrong, _ = compare(spark, QUERIES[name], SQL[name], str(tmp_path))
    assert rows >= len(docs) and wrong is None
    assert decontamination.unsigned_up_to(0.8) == 10


def test_toxicity_is_learnt_from_documents_and_located(spark, prose):
    def text(i, bad):
        parts = [prose(12, 10 * i + k) for k in range(2 + i % 9)]
        if bad:
            parts.insert(i % len(parts), f"you are a {('vileword', 'nastyish')[i % 2]}{('', 'er', 'en')[i % 3]} {prose(3, i)}")
        return ". ".join(parts) + "."

    rows = [(i, text(i, i % 5 == 0)) for i in range(600)]
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "?!. ...")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    model = trained(labelled(docs, marks))
    got = {r.doc_id: r for r in scored(docs.withColumn("score", docs.doc_id), model).collect()}
    held = [got[i] for i in range(400, 600)]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 195
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    blamed = [r.text[s.start : s.end] for r in held if r.predicted for s in r.offending]
    assert blamed and sum("vileword" in s or "nastyish" in s for s in blamed) >= 0.9 * len(blamed)
    assert all(got[i].score == 0 and got[i].offending == [] for i in (900, 901, 902))
    none = trained(labelled(docs, marks.limit(0)))
    assert all(r.score < 1e-6 for r in scored(docs.limit(20), none).collect())
    assert scored(docs.limit(0), model).count() == 0


def test_tokens_beside_many_base_spans_take_linear_time():
    import random
    import re
    import time

    from tidemark.llm import secret_scan

    draw = random.Random(8)
    signs = "abcdefghijklmnopqrstuvwxyz0123456789"
    words = [f"token={''.join(draw.choices(signs, k=12))} {''.join(draw.choices(signs, k=28))}" for _ in range(400)]
    text = " ".join(words)
    base = secret_scan.base_spans(text)
    plain = []
    for m in re.finditer(secret_scan.TOKEN.pattern, text, secret_scan.TOKEN.flags):
        value = m[0]
        mixed = any(c.isalpha() for c in value) and any(c.isdigit() for c in value)
        if mixed and secret_scan._entropy(value) >= secret_scan.MIN_ENTROPY:
            if all(m.end() <= s or e <= m.start() for s, _, e, _ in base):
                plain.append((m.start(), 3, m.end(), value))
    assert plain and secret_scan.token_spans(text, base) == plain
    long = " ".join(words * 50)  # 860 KB
    began = time.perf_counter()
    secret_scan.token_spans(long, secret_scan.base_spans(long))
    assert time.perf_counter() - began < 5
