"""Print the formatted physical plan of registered queries (scans, pushed filters, exchanges, joins).

usage: python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")

from riskmart import registry  # noqa: E402
from riskmart.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session()
    qs = registry.queries()
    for name in args or ["int_customer_credit_profile"]:
        print(f"===== {name}")
        qs[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
