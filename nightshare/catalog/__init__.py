"""Named queries over the given tables, one module per family."""

from nightshare.catalog import (  # noqa: F401
    columns,
    analyses,
    checks,
    events,
    measures,
    relational,
    silver,
    storage,
)
