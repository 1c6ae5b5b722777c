import __spark_entry__ as E

from .conftest import SF_SMALL


def test_registry_and_oracles_line_up():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {name for name in q if name != "pipeline" and not name.startswith("op")}
    assert own - set(o) == {"hashed_tfidf", "louvain", "similarity_edges_banded"}


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "name", "label"]
    rows = df.collect()
    assert len(rows) > 0
    # every label is the id of a vertex in the graph
    ids = {r.id for r in rows}
    assert {r.label for r in rows} <= ids


def test_smoke_queries(spark):
    q = E.queries()
    for name in ["scan_posts", "tag_posts", "clean_text", "similarity_edges", "usage_trend"]:
        assert q[name](spark, SF_SMALL).count() >= 0


def test_flow_knobs(spark):
    from labelnet.plans import flows
    comps = flows.tag_communities(spark, SF_SMALL, vocab_size=200, threshold=0.5, tag_count=20, algo="components")
    rows = comps.collect()
    assert rows and all(r.id <= 20 for r in rows)
    assert all(r.label <= r.id for r in rows)           # component label = smallest member id
