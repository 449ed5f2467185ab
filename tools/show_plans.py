"""Print the formatted physical plan of catalog queries (no action beyond what a query
itself runs to build its plan).

    python tools/show_plans.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corvid.plans import catalog  # noqa: E402
from corvid.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    for name in sys.argv[2:]:
        print(f"===== {name}")
        catalog.QUERIES[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
