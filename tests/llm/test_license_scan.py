import math
import re
from collections import Counter

from pyspark.sql import functions as F

from bazaarflow.llm import license_scan as scan

FILES = [
    ("a/LICENSE", "Licensed under the Apache License, Version 2.0."), ("a/b/c/x.py", "code\nmore"), ("a/b/LICENSE.txt", "Released under the MIT License."),
    ("a/y.py", "# This work is licensed under the GNU General Public License, version 3.\ncode"), ("z/q.py", "nothing"), ("root.py", ""), ("a/n.py", None),
    (None, "Released under the MIT License."), ("a/b/c/x.py", "code\nmore"), ("z/licence/w.py", "we have a licence plate somewhere in this text about cars"),
    ("z/long.py", "line\n" * 20_000 + "All rights reserved.\n" + "line\n" * 10),
]


def terms(text):
    return [t for t in re.split(r"[^\w.-]+|\.(?=\s|$)", text.lower()) if t]


def brute(files):
    """Similarity and licence of every notice line, in plain Python."""
    lines = {x for _, t in files for x in re.split(r"\r\n|[\n\r]", t or "") if re.search(scan.NOTICE, x)}
    often = Counter(t for x in lines for t in set(terms(x)))
    weight = lambda t: math.log((len(lines) + 1) / (often[t] + 1)) + 1
    vector = lambda text: {t: n * weight(t) for t, n in Counter(terms(text)).items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = {}
    for x in lines:
        v = vector(x)
        scored = [(round(sum(w * u.get(t, 0) for t, w in v.items()) / (size(v) * size(u)), 6), name) for name, u in ((n, vector(t)) for n, t in scan.TEMPLATES.items())]
        best = max(scored, key=lambda s: (s[0], [-ord(c) for c in s[1]]))
        if best[0] >= scan.LIKE:
            out[x] = best
    return out


def test_notices_and_folders(spark):
    files = spark.createDataFrame(FILES, "path string, text string").withColumn("line", F.lit("x")).withColumn("license", F.lit("y"))
    lines = {r.line: (r.similarity, r.license) for r in scan.notices(files).collect()}
    wanted = brute(FILES)
    assert {k: v[1] for k, v in lines.items()} == {k: v[1] for k, v in wanted.items()}
    assert all(abs(lines[k][0] - v[0]) < 1e-5 for k, v in wanted.items())
    found = {r.path: (r.license, r.origin, r.passed_on_by) for r in scan.licences(files).collect()}
    assert len(found) == len({p for p, _ in FILES})
    assert found["a/LICENSE"] == ("Apache-2.0", "notice", None)
    assert found["a/b/c/x.py"] == ("MIT", "folder", "a/b")
    assert found["a/n.py"] == ("Apache-2.0", "folder", "a")
    assert found["a/y.py"][:2] == ("GPL-3.0", "notice")
    assert found["z/long.py"][:2] == ("Proprietary", "notice")
    for path in ("z/q.py", "root.py", "z/licence/w.py"):
        assert found[path] == (None, None, None)
    assert scan.licences(files.limit(0)).count() == 0


def test_headers_licence_files_and_identifiers(spark):
    text = lambda name: (scan.TEXTS / f"{name}.txt").read_text()
    gpl = "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as\n * published by the Free Software Foundation, either\n * version {} of the License, or (at your option) any later version.\n */\nint main;\n"
    wanted = {
        "m/LICENSE": ("Copyright (c) 2019 Some One\n\n" + text("MIT").split("\n", 2)[2], "MIT"),
        "b/LICENSE": ("Copyright (c) 2019, Some One. All rights reserved.\n\n" + text("BSD-3-Clause"), "BSD-3-Clause"),
        "b2/LICENSE": ("Copyright (c) 2019, Some One. All rights reserved.\n\n" + text("BSD-2-Clause"), "BSD-2-Clause"),
        "g2/COPYING": (text("GPL-2.0"), "GPL-2.0"), "g3/COPYING": (text("GPL-3.0"), "GPL-3.0"), "a/LICENSE": (text("Apache-2.0"), "Apache-2.0"),
        "h2.c": (gpl.format(2), "GPL-2.0"), "h3.c": (gpl.format(3), "GPL-3.0"),
        "s.py": ("# SPDX-License-Identifier: Apache-2.0\ncode", "Apache-2.0"), "o.py": ("// SPDX-License-Identifier: MIT OR Apache-2.0\ncode", "MIT OR Apache-2.0"),
        "long.md": ("some words on other things and more of them " * 30 + "which is released under the MIT License and so on " + "with further words about that " * 30, "MIT"),
        "wrapped.md": ("a text\nthis work is licensed under the GNU\nGeneral Public License,\nversion 3 and no other\nmore text\n", "GPL-3.0"),
        "none.md": ("we have a licence plate somewhere in this text about cars\nand a driving license for them\n" * 3, None),
    }
    files = spark.createDataFrame([(p, t) for p, (t, _) in wanted.items()], "path string, text string")
    found = {r.path: r.license for r in scan.licences(files).collect()}
    assert found == {p: name for p, (_, name) in wanted.items()}


def test_notices_inside_very_long_lines(spark):
    """A licence text and a header inside one line of a minified file, and a file of nothing but notices."""
    text = lambda name: " ".join((scan.TEXTS / f"{name}.txt").read_text().split())
    code = "".join(f"function f{n}(a,b){{return a+b*{n}}};" for n in range(300))
    header = dict((n, t) for n, t in scan.HEADERS if n == "GPL-3.0")["GPL-3.0"]
    rows = {
        "m.min.js": (f"/*! {text('MIT')} */ {code}", "MIT"),
        "e.min.js": (f"{code} /* {text('MIT')} */ {code}", "MIT"),
        "g.min.js": (f"var a=1; {code} /* {header} */ {code}", "GPL-3.0"),
        "blob.txt": ("x" * 20_000 + " Released under the MIT License. " + "y" * 20_000, "MIT"),
        "plain.min.js": (code * 3, None),
        "many.txt": ("Released under the MIT License.\n" * 400, "MIT"),
    }
    files = spark.createDataFrame([(p, t) for p, (t, _) in rows.items()], "path string, text string")
    assert {r.path: r.license for r in scan.licences(files).collect()} == {p: name for p, (_, name) in rows.items()}


def test_passages_against_brute_force(spark):
    """Cosines of whole files and of one-notice windows in plain Python."""
    files = [(p, t) for p, t in FILES if t] + [("w.c", "/*\n * Licensed under the Apache License, Version 2.0 (the License);\n * you may not use this file\n */\nint x;")]
    references = {}
    for name, number, term, weight, idf in scan._references():
        references.setdefault((number, name), {})[term] = (weight, idf)
    rarity = {t: idf for terms_ in references.values() for t, (_, idf) in terms_.items()}
    rare = scan._rarity(len(references), 0)

    def best(text):
        vector = {t: n * rarity.get(t, rare) for t, n in Counter(terms(text)).items()}
        size = math.sqrt(sum(x * x for x in vector.values()))
        scored = [(-round(sum(w * r[t][0] for t, w in vector.items() if t in r) / size, 6), name) for (_, name), r in references.items()] if size else []
        return min((s for s in scored if -s[0] >= scan.LIKE), default=None)

    def bare(text):
        return [x for x in re.split(r"[\r\n]+", re.sub(r"(?m)^[\s#*/;!%>-]+|[\s*/>-]+$", "\n", text))]

    wanted = {}
    for path, text in files:
        lines = bare(text)
        joined = " ".join(lines)
        hits = [i for i, x in enumerate(lines) if re.search(scan.PASSAGE, x)]
        if not re.search(scan.PASSAGE, text):
            continue
        windows = [(True, joined)] + [(False, " ".join(lines[max(i - a, 0) : max(i - a, 0) + a + b + 1])) for i in hits for a, b in scan.LINES]
        for whole, window in windows:
            like = best(window)
            if like:
                wanted.setdefault((path, like[1], whole), set()).add(-like[0])
    found = {}
    for r in scan.passages(spark.createDataFrame(files, "path string, text string")).collect():
        found.setdefault((r.path, r.license, r.whole), set()).add(r.similarity)
    # Sentences and word windows add more; every line window and whole file must be there with its cosine.
    for key, values in wanted.items():
        assert key in found
        for v in values:
            assert min(abs(v - f) for f in found[key]) < 2e-5


def test_all_folders_above_pass_on(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    deep = "/".join(f"d{n}" for n in range(50))
    rows = [("LICENSE", mit), ("src/x.py", "x"), ("y.py", "y"), (f"{deep}/LICENSE", gpl), (f"{deep}/e/f/z.py", "z"), ("d0/d1/w.py", "w"), ("/abs/x.py", "x"), ("/top.py", "")]
    files = spark.createDataFrame(rows, "path string, text string")
    found = {r.path: (r.license, r.passed_on_by) for r in scan.licences(files).collect()}
    assert found["src/x.py"] == found["y.py"] == found["d0/d1/w.py"] == ("MIT", "")
    assert found[f"{deep}/e/f/z.py"] == ("GPL-3.0", deep)
    assert found["/abs/x.py"] == found["/top.py"] == (None, None)
    more = files.union(spark.createDataFrame([("/LICENSE", gpl)], files.schema))
    found = {r.path: (r.license, r.passed_on_by) for r in scan.licences(more).collect()}
    assert found["/abs/x.py"] == found["/top.py"] == ("GPL-3.0", "/") and found["src/x.py"] == ("MIT", "")


def test_the_query_passes_licences_on_from_upper_folders(spark, tmp_path):
    from bazaarflow.llm.queries import op10_license_scan

    rows = [(3, "Released under the MIT License.", "s"), (20_001, "word " * 100, "s"), (20_002, "word " * 100, "t")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.license, r.origin, r.passed_on_by) for r in op10_license_scan(spark, str(tmp_path)).collect()}
    assert found == {3: ("MIT", "notice", None), 20_001: ("MIT", "folder", "s"), 20_002: (None, None, None)}
