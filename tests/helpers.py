"""Plain helpers of the tests."""


def rows(df, *columns):
    """Sorted tuples of a frame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
