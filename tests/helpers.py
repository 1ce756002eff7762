"""What tests share besides fixtures."""


def values(df, *columns):
    names = columns or df.columns
    return sorted((tuple(row) for row in df.select(*names).collect()), key=str)
