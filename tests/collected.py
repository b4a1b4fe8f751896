"""What the tests of the library share."""


def rows(df):
    return [tuple(r) for r in df.collect()]
