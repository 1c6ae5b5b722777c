import zipfile

from labelnet import session


def test_checkpoint_dir_is_the_sessions(spark):
    d = session.checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    p = session.scratch_path(spark, "x")
    assert p.startswith(d.rstrip("/") + "/x-")


def test_cut_round_trips_and_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS y")
    c = session.cut(df, "t")
    assert sorted(tuple(r) for r in c.collect()) == [(i, 2 * i) for i in range(10)]
    assert "Range" not in c._jdf.queryExecution().analyzed().toString()


def test_ship_package_once_per_context(spark, tmp_path, monkeypatch):
    shipped = []
    monkeypatch.setattr(session, "_SHIPPED", set())
    monkeypatch.setattr(spark.sparkContext, "addPyFile", lambda p: shipped.append(p))
    session.ship_package(spark)
    session.ship_package(spark)
    assert len(shipped) == 1
    with zipfile.ZipFile(shipped[0]) as z:
        names = z.namelist()
    assert "labelnet/__init__.py" in names and "labelnet/operators/similarity.py" in names
