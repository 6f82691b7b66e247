from oracle.twins import oracle_sql  # noqa: F401
