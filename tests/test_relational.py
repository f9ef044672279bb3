"""JDBC sinks. No database is started: reader and writer are replaced by Parquet stand-ins."""

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter

from weblytics.sinks import relational

URL, PROPERTIES = "jdbc:none:db", {"user": "u"}
STAT = "day string, browsername string, cnt int"


@pytest.fixture
def database(monkeypatch, tmp_path):
    """Records each write; tables are Parquet folders."""
    calls = []

    class Options(dict):
        pass

    def path(table):
        return str(tmp_path / table)

    plain_option, plain_mode = DataFrameWriter.option, DataFrameWriter.mode

    def option(self, key, value):
        self.__dict__.setdefault("_seen", Options())[key] = value
        return plain_option(self, key, value)

    def mode(self, name):
        self.__dict__.setdefault("_seen", Options())["mode"] = name
        return plain_mode(self, name)

    def write(self, url, table, properties=None):
        assert (url, properties) == (URL, PROPERTIES)
        frame = self._df
        calls.append({**self._seen, "table": table, "columns": frame.columns,
                      "partitions": frame.rdd.getNumPartitions()})
        self.parquet(path(table))

    def read(self, url, table, properties=None):
        assert (url, properties) == (URL, PROPERTIES)
        return self.schema(STAT).parquet(path(table))

    monkeypatch.setattr(DataFrameWriter, "option", option)
    monkeypatch.setattr(DataFrameWriter, "mode", mode)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    return calls


def counts(spark, *rows):
    return spark.createDataFrame(rows, STAT).repartition(5)


def stored(spark):
    return sorted(tuple(r) for r in spark.read.jdbc(URL, relational.TABLE, properties=PROPERTIES).collect())


def test_append_in_two_batched_tasks(spark, database):
    relational.append_counts(counts(spark, ("1", "IE", 1)), URL, PROPERTIES, batch_size=50)
    relational.append_counts(counts(spark, ("1", "IE", 1)), URL, PROPERTIES)
    call = database[0]
    assert call["mode"] == "append"
    assert call["batchsize"] == 50
    assert call["partitions"] == 2
    assert call["columns"] == ["day", "browsername", "cnt"]
    assert call["createTableColumnTypes"] == "day VARCHAR(10), browsername VARCHAR(100)"
    assert stored(spark) == [("1", "IE", 1)] * 2


def test_overwrite_keeps_the_definition(spark, database):
    relational.append_counts(counts(spark, ("1", "IE", 1)), URL, PROPERTIES)
    relational.overwrite_counts(counts(spark, ("2", "IE", 2)), URL, PROPERTIES)
    assert database[-1]["mode"] == "overwrite"
    assert database[-1]["truncate"] is True
    assert stored(spark) == [("2", "IE", 2)]


def test_one_day_is_replaced_once(spark, database):
    relational.append_counts(counts(spark, ("1", "IE", 1), ("2", "IE", 2)), URL, PROPERTIES)
    fresh = counts(spark, ("2", "Firefox", 9), ("2", "IE", 3), ("3", "IE", 7))
    for _ in range(2):
        relational.replace_day_counts(fresh, "2", URL, PROPERTIES)
    assert stored(spark) == [("1", "IE", 1), ("2", "Firefox", 9), ("2", "IE", 3)]


def test_failed_rewrite_names_the_copy(spark, database, monkeypatch):
    relational.append_counts(counts(spark, ("1", "IE", 1)), URL, PROPERTIES)

    def fail(self, *args, **kwargs):
        raise OSError("lost")

    monkeypatch.setattr(DataFrameWriter, "jdbc", fail)
    with pytest.raises(RuntimeError, match="its new content is in") as caught:
        relational.replace_day_counts(counts(spark, ("2", "IE", 2)), "2", URL, PROPERTIES)
    copy = str(caught.value).rsplit(" ", 1)[1]
    assert spark.read.parquet(copy).count() == 2
