"""Write PLANS.md: executed (adaptive, final) physical plans of the headline
queries, as ``explain('formatted')`` prints them, for review of shuffles,
broadcasts, pushdown and code generation.

    python scripts/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, ".")
from rivulet.plans import catalog as C  # noqa: E402
from rivulet.operators import logs as L  # noqa: E402
from rivulet.plans import fixtures as FX  # noqa: E402
from rivulet.session import build_session  # noqa: E402

QUERIES = {
    "log job (parse, flag repair, fan-out)": lambda s, d: L.run_log_job(FX.log_lines(s, d)),
    "dim_current (as-of routing, cell-log fold)": C.dim_current,
    "config_asof_join": C.config_asof_join,
    "date_columns (scan pruning)": C.date_columns,
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    out = ["# PLANS", "", f"Executed physical plans at `{sf}` on local[8] (adaptive plans after",
           "execution, so broadcast conversions and reused exchanges are visible).",
           "Regenerate with `python scripts/plans.py`.", ""]
    for title, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree, _, details = text.partition("\n\n\n")
        tree = tree.split("+- == Initial Plan ==")[0]
        keep = []
        for block in details.split("\n\n"):
            head = block.strip().split("\n", 1)[0]
            if any(k in head for k in ("Scan", "Exchange", "Join", "Aggregate", "Generate")):
                keep.append(block.strip()[:1500])
        out += [f"## {title}", "", "```", tree.strip(), "", "\n\n".join(keep), "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
