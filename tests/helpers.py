"""Helpers that several test modules import."""


def as_set(df, *cols):
    return {tuple(row) for row in df.select(*cols).collect()}
