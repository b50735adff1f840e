"""Shared by the tests: data folders and row collection.  Tests import this
module by its own name; `conftest` names two files and is never imported."""

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Collect as sorted tuples (optionally a column subset)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, v) for v in t))
