"""Helpers that tests share."""


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)
