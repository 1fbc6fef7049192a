"""Independent DuckDB SQL oracles for every registered query."""

from __future__ import annotations


def all_sql() -> dict[str, str]:
    from oracle import catalog_sql, channels_sql, dimensions_sql, drawing_sql, history_sql, operators_sql, profiles_sql
    from oracle.star_sql import star_query
    out = {k: star_query(t, b) for k, (t, b) in catalog_sql.SQL.items()}
    out.update(operators_sql.SQL)
    out.update({k: star_query(t.split(), b) for k, (t, b) in operators_sql.STAR_SQL.items()})
    out.update({k: star_query(t.split(), b) for k, (t, b) in channels_sql.STAR_SQL.items()})
    out.update({k: star_query(t.split(), b) for k, (t, b) in dimensions_sql.STAR_SQL.items()})
    out.update({k: star_query(t.split(), b) for k, (t, b) in drawing_sql.STAR_SQL.items()})
    out.update({k: star_query(t.split(), b) for k, (t, b) in history_sql.STAR_SQL.items()})
    out.update({k: star_query(t.split(), b) for k, (t, b) in profiles_sql.STAR_SQL.items()})
    # the CSV round trip must return exactly the exported report
    out["csv_roundtrip"] = out["q42"]
    return out
