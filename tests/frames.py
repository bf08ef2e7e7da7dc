"""Helpers that several test modules share."""


def rows(df, *order):
    """Rows as tuples, sorted by their text so that NULL sorts too."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
