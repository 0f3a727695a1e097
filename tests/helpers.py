from datetime import datetime


def at(text):
    """Naive UTC time, as Spark returns it to a Python process in UTC."""
    return datetime.fromisoformat(text)


def tuples(df, *columns):
    """Rows as a sorted list of tuples; nulls sort as text."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(row) for row in rows), key=repr)


def shown_plan(df):
    return df._jdf.queryExecution().toString()
