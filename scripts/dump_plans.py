"""Write the formatted physical plans of the headline operators to PLANS.md.

Usage: python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from topicweave.plans import catalog  # noqa: E402
from topicweave.session import local_session  # noqa: E402

QUERIES = ["item_rollup", "item_overview", "word_count", "tfidf_long", "topk_per_topic", "rank_per_topic", "ids_to_words"]


def shorten(plan: str) -> str:
    plan = re.sub(r"INSET [^)]*?, lambda", "INSET <stop words>, lambda", plan)
    return plan


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    out = ["# Physical plans of the headline operators", "",
           f"Generated by `scripts/dump_plans.py` on `{os.path.basename(sf_dir)}` (local[8], AQE on; "
           "AQE re-plans at run time, these are the initial plans).", ""]
    for name in QUERIES:
        buf = io.StringIO()
        with redirect_stdout(buf):
            catalog.QUERIES[name](spark, sf_dir).explain("formatted")
        out += [f"## {name}", "", "```", shorten(buf.getvalue()).strip(), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
