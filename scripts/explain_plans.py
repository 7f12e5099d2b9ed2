"""Write ``explain("formatted")`` plans of registered queries to a folder.

Usage: python scripts/explain_plans.py OUT_DIR [sf_dir] [name ...]
Defaults: sf_dir /root/testdata/sf0.01, the bench headline queries.
Also prints a one-line audit per query (cross joins, Python nodes, scans).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from tidal.plans import catalog  # noqa: E402,F401
from tidal.plans.registry import QUERIES  # noqa: E402
from tidal.session import get_spark  # noqa: E402

FLAGS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
         "FlatMapGroupsInPandas", "MapInPandas")


def main() -> None:
    out = sys.argv[1]
    args = sys.argv[2:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    names = args or bench.HEADLINE
    os.makedirs(out, exist_ok=True)
    spark = get_spark()
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(text)
        flags = [k for k in FLAGS if k in text]
        scans = len(re.findall(r"^\(\d+\) Scan parquet", text, re.M))
        exchanges = len(re.findall(r"^\(\d+\) Exchange", text, re.M))
        print(f"{name:28s} scans={scans} exchanges={exchanges} flags={flags}")
    spark.stop()


if __name__ == "__main__":
    main()
