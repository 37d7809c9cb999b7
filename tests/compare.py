"""Compare Spark rows with DuckDB rows, whatever their order."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()

TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _sortable(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def differences(con, df, sql):
    """Problems found, as text; empty when rows, names and value types agree."""
    names = sorted(df.columns)
    ours = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_sortable)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != names:
        return [f"columns {names} against {sorted(columns)}"]
    order = [columns.index(n) for n in names]
    types = {d[0]: str(d[1]) for d in cursor.description}
    wrong = {n: (t, types[n]) for n, t in df.dtypes if TYPES[t] != types[n]}
    if wrong:
        return [f"types {wrong}"]
    theirs = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_sortable)
    if not ours:
        return ["no rows, which proves nothing"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    return [f"{dict(zip(names, a))} against {dict(zip(names, b))}"
            for a, b in zip(ours, theirs) if _sortable(a) != _sortable(b)]
