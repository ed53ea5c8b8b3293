"""Print the physical plans of registered queries (ids and paths trimmed).

    python tools/plans.py [--sf-dir DIR] [--mode simple|formatted] name ...

Used to keep PLANS.md honest: the excerpts there come from this output.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--mode", default="simple")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()

    from strata.queries import QUERIES
    from strata.session import local_session

    spark = local_session(8, 16)
    for name in args.names:
        df = QUERIES[name](spark, args.sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(args.mode)
        text = re.sub(r"#\d+L?", "", buf.getvalue())
        text = re.sub(r"\[plan_id=\d+\]", "", text)
        print(f"### {name}\n```\n{text.rstrip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
