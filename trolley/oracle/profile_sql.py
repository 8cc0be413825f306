"""DuckDB oracle text for the profiles (T1-T5), rendered from the declared raw schemas."""

from __future__ import annotations

from trolley.operators.profile import IQR_COLUMNS
from trolley.oracle.prefix import sql
from trolley.sources.schemas import RAW_KEYS, RAW_SCHEMAS, RAW_TABLES, type_name

_NUMERIC = ("int", "bigint", "double")


def profile_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    parts = []
    for t in RAW_TABLES:
        for f in RAW_SCHEMAS[t].fields:
            parts.append(f"""
                SELECT '{t}' AS table_name, '{f.name}' AS column_name, '{type_name(f.dataType)}' AS data_type,
                       count(*) AS total_rows, count({f.name}) AS non_null, count(*) - count({f.name}) AS missing,
                       round((count(*) - count({f.name})) / count(*) * 100.0, 2) AS missing_pct
                FROM raw_{t}""")
    q["profile_missing"] = sql("\nUNION ALL\n".join(parts))
    q["profile_shape"] = sql("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, {len(RAW_SCHEMAS[t].fields)} AS n_columns FROM raw_{t}"
        for t in RAW_TABLES))
    dup = []
    for t in RAW_TABLES:
        keys = ", ".join(RAW_KEYS[t])
        dup.append(f"""
            SELECT '{t}' AS table_name, '{",".join(RAW_KEYS[t])}' AS key_columns,
                   CAST((SELECT count(*) FROM raw_{t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{t})) AS BIGINT)
                       AS duplicate_rows,
                   CAST((SELECT count(*) FROM raw_{t}) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM raw_{t}))
                       AS BIGINT) AS duplicate_keys""")
    q["profile_duplicates"] = sql("\nUNION ALL\n".join(dup))
    iqr = []
    for t, c in IQR_COLUMNS:
        x = f"CAST({c} AS DOUBLE)"
        q1 = f"(SELECT quantile_cont({x}, 0.25) FROM raw_{t})"
        q3 = f"(SELECT quantile_cont({x}, 0.75) FROM raw_{t})"
        lower, upper = f"({q1} - 1.5 * ({q3} - {q1}))", f"({q3} + 1.5 * ({q3} - {q1}))"
        iqr.append(f"""
            SELECT '{t}' AS table_name, '{c}' AS column_name, {q1} AS q1, {q3} AS q3, {q3} - {q1} AS iqr,
                   {lower} AS lower, {upper} AS upper,
                   count(*) FILTER (WHERE {x} < {lower} OR {x} > {upper}) AS outlier_count,
                   round(count(*) FILTER (WHERE {x} < {lower} OR {x} > {upper}) / count(*) * 100.0, 2) AS outlier_pct
            FROM raw_{t}""")
    q["iqr_outliers"] = sql("\nUNION ALL\n".join(iqr))
    desc = []
    for t, f in ((t, f) for t in RAW_TABLES for f in RAW_SCHEMAS[t].fields):
        c = f.name
        num = type_name(f.dataType) in _NUMERIC
        x = f"CAST({c} AS DOUBLE)"
        stats = (f"round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, min({x}) AS min, "
                 f"quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.5) AS q50, "
                 f"quantile_cont({x}, 0.75) AS q75, max({x}) AS max") if num else (
            "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, "
            "CAST(NULL AS DOUBLE) AS q25, CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75, "
            "CAST(NULL AS DOUBLE) AS max")
        desc.append(f"""
            SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS count,
                   (SELECT count(DISTINCT {c}) FROM raw_{t}) AS unique,
                   (SELECT CAST({c} AS VARCHAR) FROM raw_{t} WHERE {c} IS NOT NULL GROUP BY {c}
                    ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
                   (SELECT count(*) FROM raw_{t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1)
                       AS freq,
                   {stats}
            FROM raw_{t}""")
    q["profile_describe"] = sql("\nUNION ALL\n".join(desc))
    return q
