"""Summarise physical plans: shuffles, join strategies, aggregates, scans.

``python -m recunify.checks.plans [query ...]`` prints one markdown block
per query (used to write PLANS.md).  The summary is read from the
``explain("formatted")`` text, i.e. the plan a user would inspect.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

NODE = re.compile(r"^\((\d+)\) (.+?)\s*(?:\[codegen id : (\d+)\])?$")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> dict:
    nodes, scans = Counter(), []
    current = None
    for line in text.splitlines():
        m = NODE.match(line.strip())
        if m:
            current = m.group(2).strip()
            nodes[current.split(" ")[0] if not current.startswith("Scan") else "Scan"] += 1
            if current.startswith("Scan"):
                scans.append({"scan": current})
            continue
        if current and current.startswith("Scan") and scans:
            for key in ("PushedFilters", "ReadSchema", "Location"):
                if line.startswith(key + ":"):
                    scans[-1][key] = line.split(":", 1)[1].strip()
    joins = {k: v for k, v in nodes.items() if k.endswith("Join")}
    aggs = {k: v for k, v in nodes.items() if k.endswith("Aggregate")}
    return {"exchanges": nodes.get("Exchange", 0), "broadcasts": nodes.get("BroadcastExchange", 0),
            "joins": joins, "aggregates": aggs, "windows": nodes.get("Window", 0),
            "group_limits": nodes.get("WindowGroupLimit", 0), "generates": nodes.get("Generate", 0),
            "scans": scans}


def render(name: str, s: dict) -> str:
    out = [f"### `{name}`", "",
           f"- shuffles (Exchange): {s['exchanges']}; broadcast exchanges: {s['broadcasts']}",
           f"- joins: {dict(s['joins']) or 'none'}",
           f"- aggregates: {dict(s['aggregates']) or 'none'}; windows: {s['windows']}; "
           f"window group limits: {s['group_limits']}; generators: {s['generates']}",
           f"- scans: {len(s['scans'])}"]
    for sc in s["scans"]:
        table = os.path.basename(sc.get("Location", "").rstrip("]")) or sc["scan"]
        out.append(f"  - `{table}` pushed `{sc.get('PushedFilters', '[]')}`; "
                   f"reads `{sc.get('ReadSchema', '?')}`")
    return "\n".join(out) + "\n"


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from recunify.plans.queries import QUERIES
    from recunify.session import local_session
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    for name in argv or sorted(QUERIES):
        print(render(name, summary(formatted(QUERIES[name](spark, sf_dir)))))


if __name__ == "__main__":
    main(sys.argv[1:])
