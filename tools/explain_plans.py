"""Write the physical plans of the headline queries to PLANS.md.

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SHOWN = ["a1_engagement_rate", "r1_rank_category", "r4_many_brands", "a6_alignment", "a10_term_frequency",
         "n1_flatten_tree", "w1_roc_curve", "t7_tfidf_documents", "a17_silhouette", "j2_prefix_match"]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from creatorlens.plans.queries import QUERIES
    from creatorlens.session import local_session
    spark = local_session(8, shuffle_partitions=16)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf_dir)}` (initial AQE plans; "
           "`*(n)` marks whole-stage-codegen stages).  Scratch paths are shortened.", ""]
    for name in SHOWN:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = []
        for line in plan.splitlines():
            if "Location:" in line:
                line = line.split("Location:")[0] + "Location: …, " + line.split("PartitionFilters:", 1)[-1].join(["PartitionFilters:", ""]) if "PartitionFilters:" in line else line
            lines.append(line[:400])
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
