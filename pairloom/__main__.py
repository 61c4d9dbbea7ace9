"""``python -m pairloom QUERY SF_DIR [OUT]``: shows a query's rows, or writes them as Parquet to OUT; without arguments lists the queries.

Run beside ``__spark_entry__.py`` it knows all queries, elsewhere those of the core.
"""

from __future__ import annotations

import importlib
import sys

from pairloom.plans import catalog
from pairloom.session import local_session


def queries() -> dict:
    try:
        return importlib.import_module("__spark_entry__").queries()
    except ImportError:
        return catalog.QUERIES


def main(args: list[str]) -> None:
    known = queries()
    if len(args) < 2:
        for name, f in known.items():
            print(f"{name}: {(f.__doc__ or '').strip().splitlines()[0] if f.__doc__ else ''}")
        return
    if args[0] not in known:
        sys.exit(f"unknown query {args[0]}")
    df = known[args[0]](local_session(), args[1])
    df.write.mode("overwrite").parquet(args[2]) if len(args) > 2 else df.show(truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
