"""Write the final (post-AQE) formatted physical plans of the headline jobs
to a Markdown file, so plan changes show up in review.

    python tools/dump_plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import subprocess
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from shoplens import registry  # noqa: E402
from shoplens.session import get_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else "docs/plans_sf0.1.md"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    head = subprocess.run(["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True).stdout.strip()
    parts = [f"# Final physical plans ({os.path.basename(sf_dir)}, local[8], AQE on, commit {head})\n"]
    for name, key in HEADLINE.items():
        df = registry.queries()[key](spark, sf_dir)
        df.collect()  # run it, so explain shows the final adaptive plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n(1)")[0].split("+- == Initial Plan ==")[0]  # the final tree
        scans = [
            block.strip()
            for block in ("\n\n(1)" + text.split("\n\n(1)", 1)[1]).split("\n\n")
            if "Scan parquet" in block.split("\n", 1)[0]
        ] if "\n\n(1)" in text else []
        details = "\n\n".join(b for b in scans if "PushedFilters" in b or "ReadSchema" in b)
        parts.append(f"## {name} (`{key}`)\n\n```\n{tree.strip()}\n\n{details}\n```\n")
    with open(out, "w", encoding="utf-8") as f:
        f.write("\n".join(parts))
    print(out)


if __name__ == "__main__":
    main(sys.argv)
