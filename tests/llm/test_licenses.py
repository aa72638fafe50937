"""License scan: cosines in plain Python, real licence texts, inheritance, edges."""

import math
import re
from collections import Counter

import pytest
from helpers import edge_docs, empty_docs
from pyspark.sql import functions as F

from lineflow.llm import license_texts as lt
from lineflow.llm import licenses

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
MIT_FILE = f"MIT License\n\nCopyright (c) 2021 Jo Doe\n\n{lt.MIT_GRANT}\n\n{lt.MIT_KEEP}\n\n{lt.WARRANTY}\n"
GPL_HEADER, GPL_LONG = lt.gnu_header("program", "GNU General Public License", "3")
CODE = "int main(int argc, char **argv) { return run(argc, argv); }\n" * 10
COMMENT = "/*\n * tool.c - does things\n *\n" + "".join(f" * {GPL_LONG[i:i + 70]}\n" for i in range(0, len(GPL_LONG), 70)) + " */\n" + CODE


def words(text):
    found = (re.sub("[.]+$", "", w) for w in re.split(licenses.WORD, text.lower()))
    return [w for w in found if re.search("[a-z0-9]", w) and w not in licenses.STOP]


def units(text):
    body = (text or "").lower().strip(licenses.BLANKS + "\n")
    lines, blocks = body.split("\n"), re.split(licenses.EMPTY_LINE, body)
    block = blocks[0]
    for opens, closes in licenses.CLOSED_COMMENTS:
        if body.startswith(opens):
            block = body[len(opens):].split(closes)[0]
    if re.match(licenses.COMMENT_LINE, body):
        n = next((i for i, x in enumerate(lines) if not re.match(f"[ \t]*{licenses.COMMENT_LINE}", x)), len(lines))
        block = "\n".join(lines[:n])
    every = [(0, body), (1, lines[0]), (1, block), *((2, x) for x in blocks + lines)]
    return [(k, x) for k, x in every if any(s in x for s in licenses.SIGNALS)]


def brute(texts):
    """(licence, score, basis) or None of each text."""
    vocabulary = {w for _, t in lt.TEMPLATES for w in words(t)}
    there = [t for t in texts if t is not None]
    df = Counter(w for t in there for w in set(words(t)) if w in vocabulary)

    def weigh(text):
        return {w: k * (math.log((len(there) + 1) / (df[w] + 1)) + 1) for w, k in Counter(words(text)).items()}

    def norm(v):
        return math.sqrt(sum(x * x for x in v.values())) or 1

    templates = [(name, weigh(t)) for name, t in lt.TEMPLATES]
    out = []
    for text in texts:
        found = []
        for kind, unit in units(text):
            own = weigh(unit)
            for name, t in templates:
                score = round(sum(own.get(w, 0) * x for w, x in t.items()) / norm(t) / norm(own), 6)
                if score >= (licenses.THRESHOLD if kind else licenses.WHOLE_THRESHOLD) and len(own.keys() & t.keys()) >= min(2, len(t)):
                    found.append((kind, -score, name))
        best = min(found, default=None)
        out.append(best and (best[2], -best[1], licenses.BASIS[best[0]]))
    return out


PROBES = [
    (COMMENT, "GPL-3.0", "header"), (GPL_LONG, "GPL-3.0", "file"), (MIT_FILE, "MIT", "file"),
    ("# SPDX-License-Identifier: Apache-2.0\nimport os\n", "Apache-2.0", "header"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later\n#include <x>", "GPL-2.0", "header"),
    ("# SPDX-License-Identifier: Zlib\nimport os\n", None, "none"),
    (" ".join(lt.gnu_header("program", "GNU Affero General Public License", "3")[:1]) + "\n\n" + CODE, "AGPL-3.0", "header"),
    (lt.gnu_header("library", "GNU Lesser General Public License", "2.1")[0] + "\n\n" + CODE, "LGPL-2.1", "header"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0", "file"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1", "file"),
    ("ISC License\n\nCopyright (c) 2020 A B\n\n" + lt.ISC_GRANT + "\n\n" + lt.ISC_WARRANTY, "ISC", "file"),
    ("Copyright (c) 2020 A B\n\n" + "\n\n".join([lt.BSD_GRANT, lt.BSD_TWO, lt.BSD_WARRANTY]), "BSD-2-Clause", "file"),
    ("Copyright (c) 2020 A B\n\n" + "\n\n".join([lt.BSD_GRANT, lt.BSD_TWO, lt.BSD_THIRD, lt.BSD_WARRANTY]), "BSD-3-Clause", "file"),
    ("\n".join("# " + x for x in lt.APACHE_HEADER.split(". ")) + "\n" + CODE, "Apache-2.0", "header"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + "Preamble text of many words. " * 300,
     "GPL-3.0", "header"),
    ("Some project does things.\n\nMore about it.\n\n" + MIT + "\n\nMore.", "MIT", "notice"),
    ("Some project\n\n# License\n\nA person at MIT got a driving license.", None, "none"),
    ("License", None, "none"), ("All rights reserved, no permission is given.", None, "none")]


def test_real_texts_against_plain_python(spark):
    """Headers in comments, whole licence files, tags, and families that share most of their words."""
    prose = [f"the program {i} is free for use by any person who has permission to copy it " * 20 for i in range(20)]
    texts = [p[0] for p in PROBES] + prose + [None, "", "no notice"]
    files = spark.createDataFrame([(i, f"d{i}/x.c", t) for i, t in enumerate(texts)], "i int, path string, text string")
    got = {r.i: r for r in licenses.scan(files).collect()}
    for i, (want, probe) in enumerate(zip(brute(texts), PROBES + [(t, None, "none") for t in texts[len(PROBES):]], strict=True)):
        r = got[i]
        assert (r.license, r.basis) == probe[1:], probe[0][:80]
        assert (r.license, r.basis) == (want[0], want[2]) if want else r.license is None
        assert r.score == (pytest.approx(want[1], abs=2e-6) if want else None)


def test_licence_file_covers_its_folder(spark):
    files = spark.createDataFrame([
        ("p/LICENSE", MIT_FILE), ("p/src/x.py", "code"), ("p/src/lib/COPYING", f"Terms\n\n{GPL}\n\n{CODE}"), ("p/src/lib/y.py", "code"),
        ("p/src/lib/z.py", "# SPDX-License-Identifier: ISC\ncode"), ("q/head.py", f"# {MIT}\n{CODE}"), ("q/x.py", "code"),
        ("r/terms.txt", MIT_FILE), ("r/x.py", "code")], "path string, text string")
    got = {r.path: (r.license, r.basis) for r in licenses.scan(files).collect()}
    assert got == {
        "p/LICENSE": ("MIT", "file"), "p/src/x.py": ("MIT", "folder:p"), "p/src/lib/COPYING": ("GPL-3.0", "notice"),
        "p/src/lib/y.py": ("GPL-3.0", "folder:p/src/lib"), "p/src/lib/z.py": ("ISC", "header"), "q/head.py": ("MIT", "header"),
        "q/x.py": (None, "none"), "r/terms.txt": ("MIT", "file"), "r/x.py": ("MIT", "folder:r")}
    opened = {r.path: (r.license, r.basis) for r in licenses.scan(files, opening=True).collect()}
    assert opened == got | {"q/x.py": ("MIT", "folder:q")}


def test_nearest_folder_wins(spark):
    files = spark.createDataFrame([
        ("a/LICENSE", GPL + "\nmore"), ("a/b/LICENSE", "\n" + MIT), ("a/b/c/x.py", "code"), ("a/d/y.py", "code"), ("z.py", "code"),
        ("a/b/own.py", "code\n" + GPL), ("ab/x.py", "code"), (None, "code"), ("a/b/c/x.py", "code")], "path string, text string")
    got = sorted({(r.path or "", r.license, r.basis.split(":")[-1]) for r in licenses.scan(files).collect()})
    assert [g for g in got if g[0] != "a/LICENSE"] == sorted([
        ("a/b/LICENSE", "MIT", "file"), ("a/b/c/x.py", "MIT", "a/b"), ("a/d/y.py", "GPL-3.0", "a"),
        ("z.py", None, "none"), ("a/b/own.py", "GPL-3.0", "file"), ("ab/x.py", None, "none"), ("", None, "none")])
    top = files.unionAll(spark.createDataFrame([("LICENSE", MIT), ("COPYING", GPL)], files.schema))
    got = {r.path: (r.license, r.basis) for r in licenses.scan(top).collect()}
    assert got["z.py"] == got["ab/x.py"] == ("GPL-3.0", "folder:")  # equal scores: the name that sorts first
    assert got["a/d/y.py"] == ("GPL-3.0", "folder:a")


def test_many_units_are_joined_salted(spark, monkeypatch):
    files = spark.createDataFrame([(f"d{i}/x", f"{MIT}\ntext {i}" if i % 3 else f"text {i}") for i in range(60)], "path string, text string")
    want = sorted(map(tuple, licenses.scan(files).collect()), key=str)
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, licenses.scan(files).collect()), key=str) == want
    assert sum(r[1] == "MIT" for r in want) == 40


def test_edges(spark):
    docs = edge_docs(spark).withColumn("path", F.col("source")).withColumn("basis", F.lit(1)).withColumn("license", F.lit(2))
    rows = licenses.scan(docs).collect()
    assert len(rows) == docs.count() and {r.basis for r in rows} == {"none"}
    assert licenses.scan(empty_docs(spark).withColumn("path", F.col("source"))).count() == 0
