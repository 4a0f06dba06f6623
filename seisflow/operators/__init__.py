"""DataFrame operators: each is ``f(df, **params) -> DataFrame``, lazy and pure."""
