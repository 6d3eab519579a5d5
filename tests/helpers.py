"""Small helpers for assertions."""


def rows(df):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def values(df):
    """Values of a one-column frame, in order."""
    return [r[0] for r in df.collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    """Physical plan after adaptive execution has run it."""
    df.collect()
    return plan_of(df)
