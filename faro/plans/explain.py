"""Print the formatted physical plan of registered queries.

Usage: ``python -m faro.plans.explain <query-name-prefix> [sf_dir]``.  Use it to
check that filters reach the scan (PushedFilters), that only needed columns
are read (ReadSchema), where exchanges sit, and which joins are broadcast.
"""

from __future__ import annotations

import sys


def main(argv: list[str]) -> int:
    from faro.plans.registry import all_queries
    from faro.session import local_session

    if not argv:
        print(__doc__)
        return 2
    prefix, sf_dir = argv[0], (argv[1] if len(argv) > 1 else "/root/testdata/sf0.01")
    spark = local_session()
    for name, q in sorted(all_queries().items()):
        if name.startswith(prefix):
            print(f"===== {name}")
            q.spark(spark, sf_dir).explain("formatted")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
