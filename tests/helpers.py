import datetime as dt

T = dt.datetime


def h(day: int, hour: int, minute: int = 0, second: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, day, hour, minute, second)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
