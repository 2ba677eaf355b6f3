"""Order-insensitive comparison of a Spark result with SQL on the same tables."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def sql_result(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    types = {c[0]: TYPES.get(str(c[1]), str(c[1])) for c in cur.description}
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in cur.fetchall())
    return types, rows


def spark_result(df):
    names = sorted(df.columns)
    rows = Counter(tuple(_plain(v) for v in r) for r in df.select(*names).collect())
    return dict(df.dtypes), rows


def differences(df, con, sql, shown=3):
    """Empty text when both agree in columns, types and rows."""
    spark_types, spark_rows = spark_result(df)
    sql_types, sql_rows = sql_result(con, sql)
    if spark_types != sql_types:
        return f"types differ: {spark_types} / {sql_types}"
    if spark_rows != sql_rows:
        only_spark = list((spark_rows - sql_rows).items())[:shown]
        only_sql = list((sql_rows - spark_rows).items())[:shown]
        return (
            f"{spark_rows.total()} / {sql_rows.total()} rows; "
            f"only Spark: {only_spark}; only SQL: {only_sql}"
        )
    return ""
