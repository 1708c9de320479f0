from __future__ import annotations


def rows(df, *columns):
    """Rows as sorted tuples, NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, v) for v in t))


def plan(df) -> str:
    """Formatted physical plan as text."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def executed_plan(df) -> str:
    """The plan after the query has run, with what adaptive execution changed. The frame itself must have been collected."""
    return df._jdf.queryExecution().executedPlan().toString()
