"""How tests look at results."""


def rows(df, *columns):
    """Sorted tuples of a result."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
