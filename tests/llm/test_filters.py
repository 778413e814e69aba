"""Decontamination, quality, toxicity, URL filter and licence scan."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ampora.llm import decontaminate, toxicity
from ampora.llm.decontaminate import contamination, remove_contaminated
from ampora.llm.labelled_urls import labelled_urls
from ampora.llm.licenses import TEMPLATES, Templates, full_texts, license_scan
from ampora.llm.quality import fit, keep_good, quality_scores
from ampora.llm.queries import QUERIES
from ampora.llm.toxicity import Lexicon, drop_toxic, fold, toxicity_scores
from ampora.llm.url_filter import judge, learn
from ampora.llm.words import slices, word_hashes

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def brute_hits(text, items):
    w = words(text)
    hit, found = [False] * len(w), set()
    for name, item in items:
        v = words(item)
        size = min(10, len(v))
        for k in range(len(v) - size + 1 if v else 0):
            for i in range(len(w) - size + 1):
                if w[i:i + size] == v[k:k + size]:
                    hit[i:i + size] = [True] * size
                    if name is not None:
                        found.add(str(name))
    return len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)


ITEMS = [(1, " ".join(f"b{i}" for i in range(14))), (2, "Tiny Item"), (3, ""), (4, None), (None, "secret words only"),
         (5, " ".join(f"b{i}" for i in range(3, 20))), (2, "other é-text")]
DOCS = [None, "", "...", "tiny", "TINY, item!", "x " + " ".join(f"B{i}" for i in range(14)) + " tiny item y",
        " ".join(f"b{i}" for i in range(9)), "b0 " * 30, " ".join(f"b{i}" for i in range(5, 25)), "secret words only",
        "other é text " * 400, "tiny item tiny item", "tiny\x00item", "secret words"]


@pytest.mark.parametrize("block", [4 << 20, 40])
def test_hits_equal_brute_force_in_any_number_of_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(DOCS)] + [(0, None, 0)], "doc_id long, text string, hits int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = contamination(spark, docs, bench).collect()
    assert len(got) == len(DOCS) + 1
    for r in got:
        assert tuple(r)[1:6] == brute_hits(DOCS[r.doc_id], ITEMS), DOCS[r.doc_id]
    kept = remove_contaminated(spark, docs, bench)
    assert kept.columns == docs.columns
    clean = {i for i, t in enumerate(DOCS) if not brute_hits(t, ITEMS)[4]}
    assert {r.doc_id for r in kept.collect()} == clean
    assert contamination(spark, docs.limit(0), bench).collect() == []
    assert contamination(spark, docs, bench.limit(0)).where("contaminated").count() == 0


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def accuracy(spark, scored, column):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where(f"{column} IS NOT NULL")
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", column).collect()
    return np.mean([r.predicted == r[column] for r in rows])


@pytest.mark.parametrize(("scores", "column", "least"), [(quality_scores, "quality", 0.97), (toxicity_scores, "toxic", 0.97)])
def test_classifiers_on_the_held_out_fold(spark, scores, column, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "word " * 200_000), (None, "text")], "doc_id long, text string")
    scored = scores(docs.select("doc_id", "text").union(extra), labels).cache()
    assert scored.count() == docs.count() + 4
    assert scored.where("score IS NULL OR score < 0 OR score > 1 OR predicted NOT IN (0, 1)").count() == 0
    assert all(r.held_out == (r.doc_id is not None and held_out(r.doc_id)) for r in scored.limit(500).collect())
    assert accuracy(spark, scored, column) >= least


def test_labels_of_the_held_out_fold_are_not_learned_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    fold_of = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    flipped = labels.withColumns({c: F.when(fold_of, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    for scores in (quality_scores, toxicity_scores):
        a, b = ({r.doc_id: r.score for r in scores(docs, x).collect()} for x in (labels, flipped))
        assert a == b


def test_classifiers_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a fine text"), (2, "idiot moron scum idiot")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality_scores(docs, none).collect()] == [0.5, 0.5]
    assert keep_good(docs, none).count() == 2
    assert [r.doc_id for r in drop_toxic(docs, none).collect()] == [1]
    assert quality_scores(docs.limit(0), none).collect() == toxicity_scores(docs.limit(0), none).collect() == []


def test_non_negative_risk_separates_from_unlabelled_data():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (4000, 3)), rng.normal(4, 1, (1000, 3))
    model = fit(good[:1500], np.concatenate([good[1500:], bad]), 0.7)
    assert (model.score(good) >= 0.3).mean() > 0.97 and (model.score(bad) >= 0.5).mean() < 0.05


def test_folding_and_exceptions():
    assert fold("1D10T Ѕсum ＴＲＡＳＨ clоwn") == fold("idiot scum trash clown")
    lexicon = Lexicon({fold("trash"): 5.0, fold("idiot"): 5.0}, (fold("trash can"),))
    assert lexicon.found("You trash, you 1diot!")[0] == 10.0
    assert lexicon.found("A trash can; a trash-can.")[0] == 0.0
    assert lexicon.found("trash can trash")[0] == 5.0
    assert lexicon.found("backtrash")[0] == 0.0
    assert lexicon.found("")[0] == 0.0
    assert toxicity.chosen_terms({"abc": (10, 5.0), "abcd": (10, 5.0), "abx": (4, 5.0), "abxy": (2, 6.0), "abxz": (2, 5.1)}) == {
        "abcd": 5.0, "abx": 5.0, "abxy": 6.0}


SIGNS_OF_THE_WEB = ["\u201c", "\u2018", "\u2019", "\u2013", "\u2014", "\u00ab", "\u00bb", "\u00a0", "\u202f", "\u3000", "\u3002", "\u300c", "\u2026",
                    "\u00bf", "\u2022", "\uff01", "\u2028", "\x85", "\U0001f621", "\u00b4", "x \u200b\u2014\u200b"]


@pytest.mark.parametrize("sign", SIGNS_OF_THE_WEB)
def test_terms_after_signs_that_are_not_ascii(sign):
    lexicon = Lexicon({fold("idiot"): 5.0, fold("trash"): 3.0}, (fold("trash can"),))
    assert lexicon.found(f"you{sign}idiot{sign}. A{sign}trash{sign}heap")[0] == 8.0
    assert lexicon.found(f"A trash{sign[-1]}can.")[0] == (3.0 if sign[-1] in "\u200b\u2026" else 0.0)
    # whatever learning can take for a word, scoring finds
    text = f"Ein{sign}schlimmes Wort{sign}fällt{sign}hier, niño\u00a0größer{sign}слово"
    for word in {w for x in toxicity.forms(text) for w in x.split()}:
        assert Lexicon({word: 1.0}, ()).found(text)[0] > 0, word


def test_accents_compatibility_forms_and_scripts():
    assert fold("ídiot İDIOT idio\u0308t 𝐈𝐝𝐢𝐨𝐭 ⓘⓓⓘⓞⓣ i\u200bd\u2060i\u00adot") == " ".join(["idiot"] * 6)
    assert fold("한국어 слово हिंदी")[:4] == "한국어 " and toxicity.forms("Réel, ＩＤＩＯＴ") == ("réei  idiot", "reei  idiot") and fold("naïve Ångström") == "naive angstrom"
    both = Lexicon({"idiot": 5.0, "réei": 2.0}, (fold("idiot proof"),))
    assert both.found("Ídiot réel \u2014 reel idiot")[0] == 12.0 and both.found("idiot pröof, ídiot proof, réel")[0] == 2.0
    assert fold("l1I") == "iii" and fold("") == "" and fold("a\tb\nc_d") == "a b c d"
    assert all(fold(chr(c)) == " " for c in range(0x80) if not chr(c).isalnum() and chr(c) not in "@$")


def test_quoted_terms_are_dropped(spark):
    texts = ["A quiet walk by the river with a friend", "\u201cidiot\u201d \u2014 \u00abmoron\u00bb\u00a0scum", "You \u2014\u00edd\u00edot\u2014, you\u00a0moron"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.doc_id for r in drop_toxic(docs, none).collect()] == [0]


URLS = [None, "", "no scheme", "http://", "://x", "http://A.NET", "http://a.net/", "http://xnet/", "http://NET/x", "https://example.net/en/1?q#f",
        "http://www.example.net/en/", "http://example.net/de/", "http://EXAMPLE.com/de/x", "http://a.org/fr/?x", "http://a.org/FR/",
        "http://casino-win.example.org/en/1", "http://www.museum.example.com/en/3", "http://h?x/y", "http://h#x/y",
        "http://u@h:80/p//q?r", "x://y://z/", "http://ünï.example.com/ß", "http://long.example.com/" + "a/" * 30_000]
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = host.translate(ASCII_LOWER)
    best = None
    for rule in sorted(RULES, key=len):
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            best = rule
    return host, path, best


def test_urls_and_rules(spark):
    labelled = spark.createDataFrame(labelled_urls() + [(None, 1), ("http://a/", None)], "url string, blocked int")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = {r.page_id: r for r in judge(pages, learn(spark, labelled)).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule = brute_url(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (RULES[rule] if rule else "block" if got[i].score >= 0.5 else "allow")
    assert got[URLS.index("http://casino-win.example.org/en/1")].verdict == "block"
    assert got[URLS.index("http://www.museum.example.com/en/3")].verdict == "allow"
    assert learn(spark, labelled.where("blocked = 1")) is None
    assert {r.verdict for r in judge(pages.where("page_id < 3"), None).collect()} == {"allow"}
    assert judge(pages.limit(0), None).collect() == []
    with pytest.raises(ValueError, match="rule"):
        judge(pages.withColumn("rule", F.lit(1)), None)


def test_url_model_on_hosts_it_has_not_seen(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    labelled = spark.createDataFrame(labelled_urls(), "url string, blocked int")
    rows = judge(pages, learn(spark, labelled)).select("host", "score").collect()
    spam = re.compile("casino-win|free-bets|cheap-pills|ads-track|spam-farm|adult-x")
    assert np.mean([r.score >= 0.5 for r in rows if spam.search(r.host)]) > 0.8
    assert np.mean([r.score >= 0.5 for r in rows if not spam.search(r.host)]) < 0.02


def test_licences(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", "foo bar"), ("a/b/c/COPYING", "zzz\nLicensed under CC BY-NC 4.0.\nfoo"),
            ("a/b/c/d/e.py", None), ("q/z.py", ""), ("LICENSE.txt", "hello world"), (None, "x y"),
            ("a/h.py", "# Licensed under the Apache License, Version 2.0.\nimport one, two, three, four, five, six, seven, eight"),
            ("a/b/x.py", "foo bar"), ("top", "long text " * 50_000 + "\nThis work is licensed under the GNU General Public License, version 3.")]
    files = spark.createDataFrame([(*r, 1) for r in rows], "path string, text string, n int")
    got = [(r.path, r.license, r.how, r.from_path) for r in license_scan(files).collect()]
    assert sorted(got, key=str) == sorted([
        ("a/LICENSE", "MIT", "file", "a/LICENSE"), ("a/b/x.py", "MIT", "inherited", "a/LICENSE"), ("a/b/x.py", "MIT", "inherited", "a/LICENSE"),
        ("a/b/c/COPYING", "CC-BY-NC-4.0", "file", "a/b/c/COPYING"), ("a/b/c/d/e.py", "CC-BY-NC-4.0", "inherited", "a/b/c/COPYING"),
        ("q/z.py", None, "none", None), ("LICENSE.txt", None, "none", None), (None, None, "none", None),
        ("a/h.py", "Apache-2.0", "header", "a/h.py"), ("top", "GPL-3.0", "header", "top")], key=str)
    assert license_scan(files.limit(0)).collect() == []
    with pytest.raises(ValueError, match="score"):
        license_scan(files.withColumn("score", F.lit(1)))


def test_licences_in_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("doc_id").cast("string").alias("path"), "text")
    got = {r.doc_id: r.how for r in license_scan(docs).collect()}
    said = duckdb.sql(f"SELECT doc_id FROM '{SF}/documents.parquet' WHERE regexp_matches(text, 'icensed under|Released under the MIT')").fetchall()
    assert {d for d, how in got.items() if how in ("header", "file")} == {d for (d,) in said}


def test_a_short_page_does_not_license_its_directory(spark):
    rows = [("src/en/1", "Was orer.\nThis work is licensed under the GNU General Public License, version 3."), ("src/en/2", "foo bar"),
            ("t/LICENSE", "Was orer.\nThis work is licensed under the GNU General Public License, version 3."), ("t/en/2", "foo bar")]
    got = {r.path: (r.license, r.how) for r in license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {"src/en/1": ("GPL-3.0", "header"), "src/en/2": (None, "none"), "t/LICENSE": ("GPL-3.0", "file"), "t/en/2": ("GPL-3.0", "inherited")}


def test_registered_licence_scan(spark, tmp_path):
    """On the given tables documents, which have no path, declare and inherit nothing from pages."""
    rows = QUERIES["op8_tfidf_license_scan"](spark, SF).collect()
    (said,), = duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet' WHERE regexp_matches(text, 'icensed under|Released under the MIT')").fetchall()
    got = Counter(r.how for r in rows if r.kind == "documents")
    assert got["inherited"] == got["file"] == 0 and got["header"] == said > 0
    (pages,), = duckdb.sql(f"SELECT count(*) FROM '{SF}/pages.parquet'").fetchall()
    assert sum(r.kind == "pages" for r in rows) == pages


def nearest_licence(files, path):
    """The licence file of the nearest directory above, by a walk over all of them."""
    parts = path.rpartition("/")[0].split("/") if "/" in path else [""]
    for n in range(len(parts), -1, -1):
        folder = "/".join(parts[:n])
        if folder in files:
            return files[folder]
    return None


def test_registered_licence_scan_inherits_as_an_ancestor_walk_does(spark, tmp_path):
    rng = random.Random(3)
    mit, gpl = ("<html><p>Released under the MIT License.</p>", "<p>This work is licensed under the GNU General Public License, version 3.</p>")
    pages, files = [], {}
    for k in range(300):
        depth = rng.randrange(1, 5)
        folder = "/".join(["Hot.example.org" if k % 3 == 0 else f"h{rng.randrange(4)}.example.org", *(rng.choice("ab") for _ in range(depth - 1))])
        named = rng.random() < 0.06
        html = rng.choice([mit, gpl]) if named else "<p>nothing said here</p>"
        host, _, rest = folder.partition("/")
        path = f"{host.lower()}/{rest + '/' if rest else ''}{'LICENSE' if named else f'{k}.html'}"
        pages.append((k, f"https://{host}{path[len(host):]}?q=/x#top", html))
        if named:
            files.setdefault(path.rpartition("/")[0], ("MIT" if html is mit else "GPL-3.0", path))
    # of two licence files in one directory, with one score, the smaller path counts: here they are one page twice
    pages = [p for i, p in enumerate(pages) if "LICENSE" not in p[1] or p[1] not in {q[1] for q in pages[:i]}]
    pages += [(900, None, mit), (901, "no-scheme/LICENSE", mit), (902, "http://h0.example.org/LICENSE-notes/x", None), (903, "http://alone.example.org", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(1, "free text"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op8_tfidf_license_scan"](spark, str(tmp_path)).collect()
    assert len(rows) == len(pages) + 2
    inherited = 0
    for r in rows:
        if r.kind == "documents" or r.path is None:
            assert r.how in ("none", "header")
        elif r.how != "file":
            found = nearest_licence(files, r.path)
            assert (r.license, r.from_path) == (found or (None, None)), r.path
            assert r.how == ("inherited" if found else "none")
            inherited += found is not None
    assert inherited > 50


CODE = "import one\n\ndef lamp(shade):\n    return shade.bulb * 17\n"
GPL3 = """/*
 * Lamp is a free reader of meters.
 * Copyright (C) 2019 Ann Example <ann@example.org>
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
 */
"""
BSD_STYLE = """// Copyright 2014 The Lamp Authors. All rights reserved.
// Use of this source code is governed by a BSD-style
// license that can be found in the LICENSE file.
"""
APACHE = """# Copyright 2020 The Lamp Company
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
LGPL21 = """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
"""
MIT_TEXT = """The MIT License (MIT)

Copyright (c) 2015 Ann Example, Bob Example and others

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
PROSE = """The committee met in the public library on Tuesday to modify the terms of its report.
Any person who wants a copy of the work may ask the office for one, free of charge.
The museum is open to the public in the summer and the file of the foundation is kept there.
A driving license is needed for the second version of the course, and you may not use your own car.
"""
NOTICES = {
    "gpl.c": (GPL3 + CODE, "GPL-3.0", "header"), "gpl2.c": (GPL3.replace("version 3", "version 2") + CODE, "GPL-2.0", "header"),
    "agpl.c": (GPL3.replace("GNU General", "GNU Affero General") + CODE, "AGPL-3.0", "header"), "bsd.go": (BSD_STYLE + CODE, "BSD-3-Clause", "header"),
    "lgpl.c": (LGPL21 + CODE, "LGPL-2.1", "header"), "apache.py": (APACHE + CODE, "Apache-2.0", "header"), "mit/COPYING": (MIT_TEXT, "MIT", "file"),
    "mit/of.py": (CODE, "MIT", "inherited"), "mit.txt": (MIT_TEXT, "MIT", "header"), "mit.js": (MIT_TEXT.split("The above")[0] + CODE, "MIT", "header"),
    "tag.c": ("/* SPDX-License-Identifier: Apache-2.0 */\n" + CODE, "Apache-2.0", "header"), "tag.rs": ("// SPDX-License-Identifier: MIT\n" + CODE, "MIT", "header"),
    "tag.h": (CODE + "# SPDX-License-Identifier: GPL-2.0-or-later\n", "GPL-2.0", "header"), "tag.md": ("<!-- SPDX-License-Identifier: WTFPL-->", "WTFPL", "header"),
    "tags.c": ("// SPDX-License-Identifier: (GPL-2.0-only OR MIT)\n" + GPL3, "(GPL-2.0-only OR MIT)", "header"),
    "none.c": ("// SPDX-License-Identifier: NONE\n" + CODE, None, "none"), "code.py": (CODE, None, "none"), "prose": (PROSE, None, "none"),
    "apart.txt": ("Licensed\nunder zeta eta theta\nthe iota kappa lamda\nMIT mu nu xi\nLicense.", None, "none"),
}


def test_usual_notices_and_texts_among_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("path"), "text")
    rows = spark.createDataFrame([(p, t) for p, (t, _, _) in NOTICES.items()], docs.schema)
    got = {r.path: (r.license, r.how) for r in license_scan(docs.union(rows)).where("NOT startswith(path, 'd/')").collect()}
    assert got == {p: (x, how) for p, (_, x, how) in NOTICES.items()}


def test_cosines_do_not_fall_as_the_corpus_grows():
    known = [t for _, t in (*TEMPLATES, *full_texts())]
    ((data, ends),) = slices(pa.array([GPL3 + CODE, BSD_STYLE + CODE, MIT_TEXT, PROSE]))
    few = Templates(known, len(TEMPLATES))
    common = {int(k): 0.9 for k in few.number(word_hashes(*next(slices(pa.array(["the of to a and in is"]))))[0])}
    found = []
    for n in (10_000, 10**9):
        templates = Templates(known, len(TEMPLATES), {k: int(share * n) for k, share in common.items()}, n)
        found.append(np.stack([*templates.nearest_run(data, ends), *templates.nearest(*word_hashes(data, ends), whole=True)]))
    assert np.abs(found[0] - found[1]).max() < 1e-3
    assert (found[1][1] >= 0.6).tolist() == [True, True, True, False] and found[1][3][2] >= 0.75


def test_runs_equal_brute_force():
    known = [t for _, t in TEMPLATES]
    rng = np.random.default_rng(5)
    lines = [x for t in (GPL3, BSD_STYLE, APACHE, LGPL21, MIT_TEXT, PROSE, CODE) for x in t.split("\n")] + ["", "of the", "zeta eta"]
    texts = ["", *("\n".join(rng.choice(lines, rng.integers(1, 30))) for _ in range(60)), *("\n".join(lines[a:a + 25]) for a in range(0, len(lines), 9)), ""]
    templates = Templates(known, len(known), {}, 50)
    ((data, ends),) = slices(pa.array(texts))
    got = templates.nearest_run(data, ends)[1]
    for text, cosine in zip(texts, got, strict=True):
        worded = [x for x in text.split("\n") if words(x)]
        runs = ["\n".join(worded[i:j]) for i in range(len(worded)) for j in range(i + 1, min(len(worded), i + 12) + 1)]
        best = 0.0
        if runs:
            hashes, bounds = word_hashes(*next(slices(pa.array(runs))))
            best = templates.nearest(hashes, bounds, whole=False)[1].max()
        assert cosine == pytest.approx(best if best >= 0.6 else 0.0), text


def brute_matches(docs, items):
    """Longest runs of equal words of ten or more, or of a whole shorter item, by every diagonal."""
    out = []
    for d, text in docs:
        w = words(text)
        for name, item in items:
            v = words(item)
            least = min(10, len(v))
            for shift in range(-len(v), len(w)):
                run = 0
                for q in range(len(v) + 1):
                    p = q + shift
                    if q < len(v) and 0 <= p < len(w) and w[p] == v[q]:
                        run += 1
                        continue
                    if run and run >= least:
                        out.append((d, name, q - run, p - run, run))
                    run = 0
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [60, 4 << 20])
def test_longest_matches_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(12)
    letters = "abc"                              # few words, so that windows repeat within items and documents
    items = [(f"i{k}", " ".join(rng.choices(letters, k=rng.choice([3, 12, 30])))) for k in range(6)]
    items += [(None, " ".join(rng.choices(letters, k=15))), ("none", "..."), ("twin", items[2][1]), ("i1", "x y z w")]
    docs = []
    for k in range(40):
        parts = [rng.choices(letters, k=rng.randrange(20)) for _ in range(2)]
        whole = rng.choice(items)[1].split()
        cut = rng.randrange(len(whole))
        docs.append((k, " ".join([*parts[0], *whole[cut:], *parts[1]])))
    docs += [(50, None), (51, ""), (52, items[0][1]), (52, items[0][1]), (None, items[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.longest_matches(spark, df, bench)
    got = sorted((tuple(r) for r in found.select("doc_id", "item", "item_start", "start", "length").collect()), key=str)
    assert got == brute_matches(docs, items)
    with pytest.raises(ValueError, match="length"):
        decontaminate.longest_matches(spark, df.withColumn("Length", F.lit(1)), bench)
