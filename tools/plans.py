"""Write PLANS.md: the physical plan tree, read schemas and pushed filters
of the headline queries (``python tools/plans.py [sf_dir]``)."""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BATCH_HEADLINE = ["q_hot_categories", "q_hot_category_sessions", "q_page_flow", "q_area_top3",
                  "q_area_top3_remark", "q_word_count", "q_search_keywords", "q_search_url",
                  "q_daily_conversion", "q_funnel_hourly", "q_item_top10", "q_repurchase_histogram",
                  "q_province_top_ads", "q_sla_overdue", "agg_count_distinct", "topk_global",
                  "join_map_lookup", "win_next_page"]


def main() -> None:
    from tessera.plans.registry import queries
    from tessera.session import get_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8)
    qs = queries()
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `python tools/plans.py {sf_dir}` (initial adaptive plans; AQE may still "
           "coalesce partitions or switch joins from runtime sizes).", ""]
    for name in BATCH_HEADLINE:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            qs[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        scans = []
        for m in re.finditer(r"\((\d+)\) Scan parquet.*?\n(.*?)\n\n", text, re.S):
            info = [l for l in m.group(2).split("\n") if l.startswith(("PushedFilters", "ReadSchema"))]
            scans.append(f"- scan ({m.group(1)}): " + "; ".join(info))
        out += [f"## {name}", "", "```", tree.rstrip(), "```", "", *scans, ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
