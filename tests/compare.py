"""Compare a query with its SQL partner, value by value."""

import glob
import os

import duckdb


def second_engine(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([row[i] for i in order] for row in rows), key=repr)


def differences(df, connection, sql):
    """Rows on one side only; empty where both agree."""
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    theirs = rows_of(names, answer.fetchall())
    ours = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if ours == theirs:
        return len(ours), []
    return len(ours), [pair for pair in zip(ours, theirs) if pair[0] != pair[1]][:2] or [
        (len(ours), len(theirs))
    ]
