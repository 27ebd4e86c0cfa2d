"""Print the formatted physical plan of registered queries.

Usage: python scripts/explain_plans.py [sf_dir] [key ...]
Streams are drained first (their query returns the sink as a batch table).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

if __name__ == "__main__":
    from flowlake.plans.catalog import DOCS, QUERIES
    from flowlake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or sorted(QUERIES)
    spark = build_session()
    for key in keys:
        print(f"==== {key}: {DOCS[key].splitlines()[0] if DOCS[key] else ''}")
        QUERIES[key](spark, sf).explain("formatted")
