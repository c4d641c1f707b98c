"""What several test modules share."""


def rows(df, *order):
    """Rows of a frame as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
