"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import bisect
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from palimpsest.llm import common, digest, license_scan, line_dedup, mixing, near_dup, packing, substrings, topk, toxicity, warc
from palimpsest.llm.queries import tokenizer_files

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
REPEATED = "this very line stands in many documents and is long enough to count"
ROWS = [
    (1, None, "en", None, None),
    (2, "", "en", "a", 0),
    (3, "   \t ", "en", "a", 6),
    (4, "one", "en", "b", 3),
    (5, LONG, "en", "b", len(LONG)),
    (6, REPEATED, "en", "b", 60),
    (6, REPEATED, "en", "b", 60),
    (7, f"{REPEATED}\nand more", "en", None, 70),
    (8, f"  {REPEATED.upper()}  \nZ", "en", "c", 70),
    (9, f"x\n{REPEATED}", "en", "c", 70),
    (None, f"{REPEATED}\nnull id", "en", "c", 70),
    (10, "日本語 のテキスト " * 60, "ja", "c", 600),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["score", "predicted", "spans", "shard", "h", "n", "size", "position", "doc", "sig", "row", "start", "_drop", "n_lines", "_size", "_row", "_of", "_at", "_copy", "_words", "_doc", "_to", "_cuts", "at", "low", "ord", "words", "slice", "copy", "part", "id", "cuts", "carried", "_id", "_key", "_bucket", "_ghost", "node", "s1", "t", "_0", "leaf", "rest", "crcs"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def wide(docs):
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("clash"))
    return docs


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_shared_folder():
    """A cluster that names no shared folder gets an error, not one of the driver's."""

    class Cluster:
        conf, sparkContext = {}, type("Context", (), {"master": "spark://x"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Cluster())


def test_stored_tables(spark, docs):
    stored = common.materialize(docs.select("doc_id"), "stored")
    numbers = sorted(tuple(r) for r in common.numbered(docs.select("doc_id", "source"), "numbered", "n", F.col("doc_id").asc_nulls_last(), "source").select("n", "doc_id").collect())
    assert [n for n, _ in numbers] == list(range(len(ROWS))) and [d for _, d in numbers] == sorted((r[0] for r in ROWS), key=lambda d: (d is None, d))
    common.discard(stored)
    with pytest.raises(Exception, match="(?i)not.found|does not exist|doesn't exist"):
        stored.collect()


def test_toxicity(spark, docs, wide, empty):
    constant = toxicity.train(docs, labels(spark, [(4, 1, 1), (5, None, None), (None, 1, 1)]))
    assert constant.crf is None
    for rows in (docs, wide):
        out = toxicity.score(rows, constant).collect()
        assert len(out) == len(ROWS) and {r.score for r in out} == {constant.constant}
    assert toxicity.train(empty, labels(spark)).constant == 0.0
    model = toxicity.train(docs, labels(spark, [(i, 1, i % 2) for i in range(1, 11)]))
    out = toxicity.score(wide, model).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[1] == by[2] == by[3]
    assert toxicity.score(empty, model).count() == 0


def test_line_dedup(docs, wide, empty):
    for rows in (docs, wide):
        out = line_dedup.dedup_lines(rows).collect()
        assert len(out) == len(ROWS)
        kept = sorted(((r.doc_id or 0, r.n_lines, r.n_dropped, r.kept_text) for r in out), key=str)
        assert (9, 2, 0, f"x\n{REPEATED}") in kept  # the largest id keeps the line
        assert (7, 2, 1, "and more") in kept and (8, 2, 1, "Z") in kept and (0, 2, 1, "null id") in kept
        assert kept.count((6, 1, 1, "")) == 2
        assert (1, 1, 0, "") in kept and (5, 1, 0, LONG) in kept
    assert line_dedup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("hot", [4096, 1])
@pytest.mark.parametrize("others", [2, 8])
def test_line_dedup_null_ids(spark, monkeypatch, hot, others):
    """Rows without an id lose a line that another row keeps, and keep one that only they have, hot or cold."""
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    both, alone = "a line that rows with and without an id repeat", "a line that only rows without an id repeat"
    rows = [(None, f"{both}\n{alone}\n{i}") for i in range(6)] + [(i, f"{both}\n{i}") for i in range(others)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = sorted(((r.doc_id, r.kept_text) for r in out), key=str)
    want = [(None, f"{alone}\n{i}") for i in range(6)] + [(i, f"{both}\n{i}" if i == others - 1 else str(i)) for i in range(others)]
    assert kept == sorted(want, key=str)


@pytest.mark.parametrize("hot", [4096, 1])
def test_line_dedup_repeated_ids(spark, monkeypatch, hot):
    """Documents are distinct ids: two ids over five rows are two documents, and rows with the largest id keep the line."""
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    line, other = "a line that two documents hold in five of their rows", "a line that five documents hold in six of their rows"
    rows = [(i % 2, f"{line}\n{i}") for i in range(5)] + [(10 + i, f"{other}\n{i}") for i in range(5)] + [(14, f"{other}\nx")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = rows[:5] + [(10 + i, str(i)) for i in range(4)] + [(14, f"{other}\n4"), (14, f"{other}\nx")]
    assert sorted((r.doc_id, r.kept_text) for r in out) == sorted(want)


def test_carried_columns(spark, docs, wide, empty):
    """Columns are carried under any names, an operator's own among them."""
    names = tuple(c for c in CLASHING if c not in ("n_lines", "spans"))  # those that the results have
    for out in (line_dedup.dedup_lines(wide, carry=names), substrings.remove_repeats(wide, carry=names)):
        assert out.columns[-len(names) :] == list(names)
        assert all(r[c] == "clash" for r in out.collect() for c in names)


def test_mixing(docs, wide, empty):
    for rows in (docs, wide):
        out = mixing.curriculum(rows).collect()
        assert len(out) == len(ROWS)
        assert all(r.taken <= 3 * r.size for r in out)
        for s in {r.source_size for r in out}:
            part = [r for r in out if r.source_size == s]
            assert abs(sum(r.taken for r in part) - part[0].target) < 2
        positions = [r.position for r in out if r.position is not None]
        assert positions == sorted(positions)
    assert mixing.curriculum(empty).count() == 0
    blank = mixing.curriculum(docs.filter("doc_id <= 3")).collect()
    assert [r.target for r in blank] == [0.0] * 3 and [r.taken for r in blank] == [0] * 3


def test_mixture(docs, wide, empty):
    out = mixing.mixture(wide)
    assert out.columns == wide.columns
    words = sum(len((r.text or "").split()) for r in out.collect())
    assert abs(words - sum(len((r[1] or "").split()) for r in ROWS)) <= 8
    assert mixing.mixture(empty).count() == 0
    assert mixing.first_words("a  b\tc", 2) == "a  b" and mixing.first_words("a", 0) == ""


def test_mixture_takes_whole_documents(spark):
    """Of each source one document at most is cut; sources over and under their size, and rows that repeat."""
    text = {i: " ".join(f"d{i}w{j}" for j in range(5 + i % 7)) for i in range(120)}
    rows = [(i, text[i], "abc"[i % 3]) for i in range(120)] + [(1, text[1], "b"), (1, text[1], "c"), (7, text[7], None)]
    rows += [(500 + i // 40, "the same words in many rows", "b") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = {r.source: r.target for r in mixing.source_targets(docs.select("source", common.word_count(F.col("text")).alias("size"))).collect()}
    taken_by_mix = Counter()
    for r in mixing.mix(docs).collect():
        taken_by_mix[r.doc_id] += r.taken
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in targets}
    assert any(targets[s] < sizes[s] for s in targets) and any(targets[s] > sizes[s] for s in targets)
    whole = {(d, s): t for d, t, s in rows}
    out = mixing.mixture(docs).collect()
    for s, target in targets.items():
        own = [r for r in out if r.source == s]
        assert sum(len(r.text.split()) for r in own) == int(target)
        cut = [r for r in own if r.text != whole[r.doc_id, s]]
        assert len(cut) <= 1 and all(whole[r.doc_id, s].startswith(r.text) for r in cut)
        held, taken = Counter((d, x) for d, _, x in rows if x == s), Counter((r.doc_id, s) for r in own)
        assert all(target // sizes[s] * n <= taken[k] <= (target // sizes[s] + 1) * n for k, n in held.items())
    words = Counter()
    for r in out:
        words[r.doc_id] += len(r.text.split())
    assert words == +taken_by_mix  # the same words that mix counts


def test_positions_follow_the_schedules(spark):
    """The position is where a schedule's numeric integral reaches a document's first word; schedules go by source, not by weight."""
    schedules = (mixing.Schedule(0.0, 4.0), mixing.Schedule(3.0, 1.0), mixing.Schedule(1.0, 1.0))
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "abcd"[i % 4]) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, schedules).collect()
    text = {i: t for i, t, _ in rows}
    for n, source in enumerate("abcd"):
        own = sorted((r for r in out if "abcd"[r.doc_id % 4] == source), key=lambda r: hashlib.md5(f"{r.doc_id} {text[r.doc_id]}".encode()).hexdigest())
        steps = 20_000
        weight = [schedules[n % 3].start + (schedules[n % 3].end - schedules[n % 3].start) * (t + 0.5) / steps for t in range(steps)]
        demand = [0.0]
        for w in weight:
            demand.append(demand[-1] + w)
        words, low = int(own[0].target), 0
        for r in own:
            assert (r.position is None) == (r.taken == 0)
            if r.position is not None:
                assert abs(bisect.bisect_left(demand, low / words * demand[-1]) / steps - r.position) < 1e-3
            low += r.size
    assert len({r.target for r in out}) > 1


def test_substrings(docs, wide, empty):
    for rows in (docs, wide):
        out = substrings.remove_repeats(rows).collect()
        assert len(out) == len(ROWS)
        by = {r.doc_id: r for r in out}
        assert by[1].n_bytes == 0 and by[1].kept == b"" and by[4].n_removed == 0
        assert by[10].n_removed == by[10].n_bytes  # repeats itself all along
        assert by[5].n_removed == len(LONG)
    assert substrings.remove_repeats(empty).count() == 0


def test_license_scan(spark, docs, wide, empty):
    assert license_scan.license_scan(wide).filter("n_recognised = 0").count() == len(ROWS)
    assert license_scan.license_scan(empty).count() == 0
    mit = "Copyright 2020 X\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\nRedistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\nRedistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    rows = [(1, mit), (2, "x. Released under the MIT License. Licensed under CC BY-NC 4.0."), (3, bsd), (4, "The MIT License is released under duress."), (5, mit.replace("\nThe above", "\nReleased under the MIT License.\nThe above"))]
    out = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].licenses == "MIT" and out[1].rules == "mit-full"
    assert out[2].licenses == "CC-BY-NC-4.0,MIT" and out[3].rules == "bsd-3-full" and out[4].licenses == ""
    assert out[5].rules == "mit-short"  # another known sentence breaks the sequence


MIT = """MIT License

Copyright (c) 2020 X

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
ISC = """Copyright 2020 X

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
BSD_2 = """Copyright 2020 X

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD_3 = BSD_2 + """

3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0"""
GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
WRAPPED = {"mit-full": MIT, "isc-full": ISC, "bsd-2-full": BSD_2, "bsd-3-full": BSD_3, "apache-header": APACHE, "gpl-3-header": GPL, "gpl-2-header": GPL.replace("version 3", "version 2"), "mpl-header": MPL}
WRAPPED |= {name: "Some words\n" + license_scan.SENTENCES[parts[0]].replace(" the ", "\nthe ").replace(" cc", "\nCC") + "." for name, _, parts in license_scan.RULES if name.endswith(("-short", "-short-2"))}


def test_wrapped_licenses(spark):
    """Every rule finds its text hard-wrapped, in comments, with other line ends and right below another line."""
    assert WRAPPED.keys() == {name for name, _, _ in license_scan.RULES}
    shapes = {"plain": lambda t: t, "hash": lambda t: "# " + t.replace("\n", "\n# "), "star": lambda t: "/*\n * " + t.replace("\n", "\n * ") + "\n */", "crlf": lambda t: t.replace("\n", "\r\n"), "below": lambda t: "Copyright 2020 X\n" + t}
    rows = [(f"{name} {shape}", name, f(text)) for name, text in WRAPPED.items() for shape, f in shapes.items()]
    out = license_scan.license_scan(spark.createDataFrame(rows, "doc_id string, rule string, text string"), carry=("rule",)).collect()
    assert [(r.doc_id, r.rules) for r in out if r.rules != r.rule] == []
    cut = [(0, WRAPPED["mpl-header"].replace("Public\nLicense", "Public\n\nLicense")), (1, "Not licensed under the\nMIT license."), (2, "Licensed under the MIT license\nagreement."), (3, "Henry v. Licensed under the MIT license.")]
    out = license_scan.license_scan(spark.createDataFrame(cut, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.rules for r in out] == ["", "", "mit-short-2", "mit-short-2"]


def test_top_k(spark):
    schema = "vec_id long, embedding array<float>, label int, score string"
    rows = [(0, [1.0, 0.5], 1, "x"), (0, [1.0, 0.5], 1, "x"), (1, [1.0, 0.5], 1, "x"), (2, [1.0, 0.5], 1, "x"), (3, None, 1, None), (4, [None, 1.0], 1, ""), (5, [float("nan"), 1.0], 1, ""), (6, [float("inf"), 1.0], 1, ""), (None, [1.0, 1.0], 1, ""), (7, [], 1, ""), (8, [-1.0], 1, "")]
    out = [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, schema), F.col("vec_id") == 0).orderBy("rank").collect()]
    assert out == [(0, 1, 1, 1310720), (0, 2, 2, 1310720), (0, 3, 7, 0), (0, 4, 8, -1048576)]
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") == 0).count() == 0
    big = spark.createDataFrame([(0, [1e12, 1.0]), (1, [2e12, 3.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="may not fit"):
        topk.top_k(big, F.col("vec_id") == 0).collect()


def test_digest(docs, wide, empty):
    for rows in (docs, wide):
        out = digest.successors(rows).collect()
        assert len(out) == len(ROWS)
        six = [r for r in out if r.doc_id == 6]
        assert len({r.fingerprint for r in six}) == 1 and sorted(r.near_next == 1.0 for r in six) == [False, True]
        one = next(r for r in out if r.doc_id == 1)
        assert one.n_chars == 0 and one.fingerprint == "" and one.edited_sha256 == hashlib.sha256(b"").hexdigest()
        assert all(0 <= x <= 1 for r in out for x in (r.near_edited, r.near_next))
    assert digest.successors(empty).count() == 0
    alone = digest.successors(docs.filter("doc_id = 4")).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"ono").hexdigest()


def test_packing(docs, wide, empty):
    for rows in (docs, wide):
        out = packing.pack(rows, *tokenizer_files(), ids_out=True).collect()
        assert {r.doc_id for r in out} == {r[0] for r in ROWS}
        blank = [r for r in out if r.doc_id == 1]
        assert [(r.length, r.doc_tokens, list(r.ids)) for r in blank] == [(1, 1, [0])]
    assert packing.pack(empty, *tokenizer_files()).count() == 0


def test_warc(spark):
    schema = "page_id long, url string, html string, payload string, record_type int"
    big = "x" * 500_000
    rows = [(1, "u", None, "c", 1), (2, None, "", "c", 1), (3, "a b\n", "é" * 60, "c", 1), (2, "u", "é" * 60, "c", 1), (4, "u", big, "c", 1), (4, "u", big, "c", 1), (9, "u", big, "c", 1), (None, "u", big, "c", 1), (5, "u", "short", "c", 1), (6, "u", "short", "c", 1)]
    out = sorted(((r.page_id or -1, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(spark.createDataFrame(rows, schema)).collect()), key=str)
    want = [(1, 0, "response", None), (2, 0, "response", None), (3, 120, "revisit", 2), (2, 120, "response", None), (4, 500_000, "response", None), (4, 500_000, "response", None), (9, 500_000, "revisit", 4), (-1, 500_000, "revisit", 4), (5, 5, "response", None), (6, 5, "response", None)]
    assert out == sorted(want, key=str)
    assert warc.round_trip(spark.createDataFrame([], schema)).count() == 0


def test_near_duplicates(docs, wide, empty):
    for rows in (docs, wide):
        out = near_dup.near_duplicates(rows, k=3, num=90, den=100).collect()
        assert len(out) == len(ROWS)
        found = {(r.doc_id, r.n_shingles, r.component_id) for r in out}
        assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4)} <= found
        assert [(r.n_shingles, r.component_id) for r in out if r.doc_id == 6] == [(11, 6)] * 2
    assert near_dup.near_duplicates(empty).count() == 0
