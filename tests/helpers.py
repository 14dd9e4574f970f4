"""Small helpers of the tests."""


def rows(df, *order):
    """Rows as tuples, sorted (NULLs first)."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
