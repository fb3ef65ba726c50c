"""Named queries over the given tables, each with SQL that must give the same rows."""

from __future__ import annotations

from slipstream.registry import base


def all_queries() -> tuple[dict[str, base.Builder], dict[str, str]]:
    """Builders and check SQL by name."""
    from slipstream.registry import feature_queries, model_queries, report_queries  # noqa: F401

    return base.BUILDERS, base.SQL
