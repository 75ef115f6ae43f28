import pytest

import __spark_entry__
from tests.oracle import same
from toolgraph.plans import graph_queries, text_queries

QUERIES = graph_queries.QUERIES | text_queries.QUERIES
ORACLE = graph_queries.ORACLE | text_queries.ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf_dir, name):
    same(QUERIES[name](spark, sf_dir), ORACLE[name], sf_dir)


def test_entry_points_agree(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["producer", "consumer", "param", "score", "route"]


def test_generated_skeletons_keep_the_samplers_rules(spark, sf_dir):
    edges = {(r.src, r.dst) for r in graph_queries.proxy_edges(spark, sf_dir).collect()}
    rows = QUERIES["generated_skeletons"](spark, sf_dir).collect()
    assert rows
    seen = set()
    for r in rows:
        core, extra = r.meta.core_chain_nodes, r.meta.distractor_nodes
        assert 2 <= len(core) <= 4 and len(set(core)) == len(core)
        assert not set(core) & set(extra) and len(extra) == int(len(core) * 0.5) + 1
        assert sorted(n.name for n in r.nodes if n.role == "core") == sorted(core)  # nodes are shuffled
        assert [(e.step, e["from"], e.to) for e in r.edges] == [(k + 1, a, b) for k, (a, b) in enumerate(zip(core, core[1:]))]
        assert all((a, b) in edges for a, b in zip(core, core[1:]))
        seen.add(tuple(sorted(zip(core, core[1:]))))
    assert len(seen) == len(rows)
