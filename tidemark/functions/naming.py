"""Names of layers, tables and metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Chains whose prefix a metric key may carry.
CHAINS = ("celo", "xdc", "eth", "fuse")


def base_metric(key: Column) -> Column:
    """A metric key without its chain."""
    return F.regexp_replace(key, f"^({'|'.join(CHAINS)})_", "")


def schema_name(target: str, layer: str | None, default: str, sandbox: str = "sandbox") -> str:
    """Production tables go to the schema of their layer, all others to the sandbox."""
    if target != "prod":
        return sandbox
    return layer.strip() if layer and layer.strip() else default
