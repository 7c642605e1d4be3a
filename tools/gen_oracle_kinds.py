"""Record every registered query's output columns and types (analysis only, no
execution) into camstat/plans/oracle_kinds.json; oracle_sql() uses it to cast
the DuckDB result to the same types.  Re-run after changing a query."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from camstat import plans
    from camstat.plans.registry import output_kinds
    from camstat.session import get_spark
    spark = get_spark(os.environ.get("CAMSTAT_MASTER", "local[2]"), 2)
    plans.load_all()
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:]  # only these; the others stay as written
    out = {}
    if names:
        with open(plans.KINDS_FILE) as fh:
            out = json.load(fh)
    for name in sorted(names or plans.ORACLES):
        out[name] = output_kinds(plans.QUERIES[name](spark, sf))
    with open(plans.KINDS_FILE, "w") as fh:
        json.dump(out, fh, indent=1, sort_keys=True)
    print(f"wrote {len(out)} entries")


if __name__ == "__main__":
    main()
