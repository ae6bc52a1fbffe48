"""Reading physical plans."""


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
