"""What several test modules use."""


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
