"""DuckDB texts that state each query over the same parquet tables."""


def all_sql() -> dict[str, str]:
    from oracle import checks, customers, explore, propensity, views
    out: dict[str, str] = {}
    for module in (views, checks, explore, customers, propensity):
        out.update(module.SQL)
    return out
