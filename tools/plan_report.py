"""Physical-plan summary of every batch catalogue query (exchanges, broadcasts, Python, pushdown).

Usage: python tools/plan_report.py [SF_DIR]   (stream queries run jobs to build, so they are skipped)
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lineflow.catalogue import QUERIES  # noqa: E402
from lineflow.session import local_session  # noqa: E402

SKIP_PREFIX = ("stream_",)
# These build their input files first (jobs), then plan the read.
BUILDS_INPUT = ("file_lines", "bolt_frames")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("| query | exchanges | broadcasts | Python operators | generators | pushed filters | columns read |")
    print("|---|---|---|---|---|---|---|")
    for name, q in QUERIES.items():
        if name.startswith(SKIP_PREFIX):
            continue
        text = plan_text(q(spark, sf))
        tree = text.split("\n\n")[0]
        exchanges = len(re.findall(r"\bExchange\b", tree))  # shuffles; broadcasts counted apart
        broadcasts = len(re.findall(r"BroadcastExchange", tree))
        python = len(re.findall(r"MapInArrow|ArrowEvalPythonUDTF|BatchEvalPython|ArrowEvalPython", tree))
        generators = len(re.findall(r"\bGenerate\b", tree))
        pushed = sorted(set(re.findall(r"PushedFilters: \[(.*?)\]", text)))
        reads = sorted(set(re.findall(r"ReadSchema: struct<(.*?)>", text)))
        cols = "; ".join(", ".join(c.split(":")[0] for c in r.split(",")) for r in reads)
        note = " (input built first)" if name in BUILDS_INPUT else ""
        print(f"| `{name}`{note} | {exchanges} | {broadcasts} | {python} | {generators} | "
              f"{'; '.join(pushed) or '-'} | {cols or '-'} |")


if __name__ == "__main__":
    main()
