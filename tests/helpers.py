import datetime as dt
import decimal
import io
from contextlib import redirect_stdout


def d(text):
    return None if text is None else dt.date.fromisoformat(text)


def rows(df, *columns):
    """The rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def executed_plan(df):
    """The final plan of a frame, after it ran."""
    df.collect()
    return plan(df)


def canonical(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (decimal.Decimal, float)):
        return repr(float(value))
    return repr(value)
