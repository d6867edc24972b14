"""Print ``explain("formatted")`` for registered queries.

Usage: python tools/explain_plans.py [sf_dir] [name ...]
(no names: the bench's headline queries)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from bench import HEADLINE
    from scorewell.plans.queries import queries
    from scorewell.session import local_session
    names = argv[2:] or HEADLINE
    spark = local_session(8)
    qs = queries()
    for name in names:
        print(f"===== {name}", flush=True)
        qs[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
