"""Registered queries over the given tables, with SQL counterparts."""


def all_checks():
    """Both registries, after all check modules are loaded."""
    from tallyspark.checks import loading, mapping, registry, scoring  # noqa: F401

    return dict(registry.QUERIES), dict(registry.ORACLES)
