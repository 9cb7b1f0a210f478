"""DataFrame -> DataFrame steps; combine them with ``df.transform(step(...))``."""
