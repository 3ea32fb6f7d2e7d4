"""Helpers of the tests; a module of its own, as each test folder has its own conftest."""


def rows(df, *cols):
    """Result rows as sorted tuples (order-insensitive compare)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
