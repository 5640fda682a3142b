"""NOT IN three-valued logic and due-run filter precedence."""

from pyspark.sql import functions as F

from lakeloom import fixtures as fx
from lakeloom.operators import control as ctl


def _runs(spark):
    return spark.createDataFrame([("a",), ("b",), (None,)], "sourceid string")


def _vals(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "v string")


def _ids(df):
    return sorted((r.sourceid or "<null>") for r in df.collect())


def test_not_in_dataframe_semantics(spark):
    r = _runs(spark)
    assert _ids(ctl.not_in(r, "sourceid", _vals(spark, []))) == ["<null>", "a", "b"]
    assert _ids(ctl.not_in(r, "sourceid", _vals(spark, ["a"]))) == ["b"]
    assert _ids(ctl.not_in(r, "sourceid", _vals(spark, ["a", None]))) == []
    # same answers as Spark SQL's own NOT IN
    r.createOrReplaceTempView("r_t")
    _vals(spark, ["a", None]).createOrReplaceTempView("v_t")
    assert spark.sql("select * from r_t where sourceid not in (select v from v_t)").count() == 0


def test_not_in_list_semantics(spark):
    r = _runs(spark)
    assert _ids(ctl.not_in(r, "sourceid", [])) == ["<null>", "a", "b"]
    assert _ids(ctl.not_in(r, "sourceid", ["b"])) == ["a"]
    assert _ids(ctl.not_in(r, "sourceid", ["b", None])) == []


def test_source_list_overrides_frequency(tables):
    h, d = fx.control_header(tables), fx.control_detail(tables)
    weekly = d.where((F.col("loadfrequency") == "Weekly") & (F.col("dataflowflag") == "bronze_to_silver")
                     & (F.col("isreadyforexecution") == 1) & (F.col("isapplicable") == 1)).select("sourceid").limit(3)
    ids = [r.sourceid for r in weekly.collect()]
    got = ctl.due_runs(h, d, None, ctl.RunFilter(sources=ids, load_frequency="Daily"))
    assert sorted(r.sourceid for r in got.collect()) == sorted(ids)


def test_split_list():
    assert ctl.split_list("a|b", "|") == ["a", "b"]
    assert ctl.split_list("", ",") is None
    assert ctl.split_list(None) is None
