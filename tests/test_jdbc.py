"""JDBC option building per dialect; the password never shows in a repr."""

import pytest

from lakeloom.sources.jdbc import Profile, jdbc_options


def test_dialects_and_partitioned_read():
    p = Profile.from_dict({"dialect": "mssql+pyodbc", "connection": {
        "host": "h", "database": "db", "username": "u", "password": "secret"}})
    o = jdbc_options(p, table="dbo.t", partition_column="id", lower_bound=1, upper_bound=100, num_partitions=8)
    assert o["url"] == "jdbc:sqlserver://h:1433;databaseName=db"
    assert o["numPartitions"] == "8" and o["partitionColumn"] == "id" and o["dbtable"] == "dbo.t"
    assert "secret" not in repr(p)
    pg = Profile("postgresql", "h", "w", "u", "pw", 5432, "ods")
    assert jdbc_options(pg, table="t")["dbtable"] == "ods.t"
    assert jdbc_options(pg, query="select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        jdbc_options(Profile("db2", "h", "d", "u"), table="t")
    with pytest.raises(ValueError):
        jdbc_options(pg, table="t", partition_column="id")
