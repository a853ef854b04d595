"""What several test modules share."""


def rows(df):
    """The rows as a sorted list of tuples, NULLs last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])
