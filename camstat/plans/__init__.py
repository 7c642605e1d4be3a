"""Named end-to-end plans over the driver tables (see ``registry``)."""

from camstat.plans.registry import ORACLES, QUERIES  # noqa: F401


def load_all() -> None:
    """Import every plan module so its queries register."""
    from camstat.plans import (  # noqa: F401
        ecology, detections, identity, windows_q, spatial_q, classify_q, learning_q, quality_q, extras_q,
        sources_q, helpers_q, gis_q,
    )


KINDS_FILE = __import__("os").path.join(__import__("os").path.dirname(__file__), "oracle_kinds.json")


def oracle_sql() -> dict[str, str]:
    """Oracle SQL per query, wrapped to the plan's output column types."""
    import json
    import os
    from camstat.plans.registry import wrap_sql
    load_all()
    kinds = {}
    if os.path.exists(KINDS_FILE):
        with open(KINDS_FILE) as fh:
            kinds = json.load(fh)
    return {k: wrap_sql(v, kinds.get(k)) for k, v in ORACLES.items()}
