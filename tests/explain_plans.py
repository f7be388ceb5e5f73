"""Write the formatted physical plan of every registered query to a folder.

Usage: python tests/explain_plans.py OUT_DIR [sf_dir] [name ...]
One ``<name>.txt`` per query, plus a one-line summary per query on stdout:
scans, exchanges (shuffles), broadcasts, sort-merge joins and aggregates.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    out = argv[1]
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    names = argv[3:]
    from __spark_entry__ import queries
    from marketprep.session import get_session
    spark = get_session("local[8]", shuffle_partitions=16)
    os.makedirs(out, exist_ok=True)
    for name, fn in queries().items():
        if names and name not in names:
            continue
        df = fn(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        text = buf.getvalue()
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(text)
        count = lambda pat: len(re.findall(pat, text.split("\n\n")[0]))
        print(f"{name:24s} scans={count(r'Scan parquet')} shuffles={count(r'(?<!Broadcast)Exchange \(')}"
              f" broadcasts={count(r'BroadcastExchange')} smj={count(r'SortMergeJoin')}"
              f" aggs={count(r'(Hash|Sort)Aggregate')}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
