"""Disk: documents are compressed, built in rounds, and leave no tables of their own behind."""

import os

from conftest import SF001
from flowlake import session
from flowlake.operators import canvas
from flowlake.plans import browse_queries
from flowlake.sources.flowdocs import build_flow_docs, read_flow_docs, write_estate_docs
from flowlake.sources.tables import Estate


def _folder(spark):
    return set(os.listdir(session.ensure_checkpoint_dir(spark).removeprefix("file:")))


def _texts(df):
    return sorted(map(str, df.collect()))


def test_documents_are_compressed_and_nothing_else_stays(spark):
    before = _folder(spark)
    path = browse_queries._docs_path(spark, SF001)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert {n.split("-")[0] for n in _folder(spark) - before} == {"flowdocs"}


def test_documents_of_rounds_equal_those_of_one(spark, tmp_path, monkeypatch):
    e = Estate.load(spark, SF001)
    tables = (e.groups, e.processors, e.connections, e.ports, e.funnels, e.labels)
    monkeypatch.setattr(session, "ROUND_ROWS", 1500)
    write_estate_docs(str(tmp_path / "docs"), *tables)
    docs, once = read_flow_docs(spark, str(tmp_path / "docs")), build_flow_docs(*tables)
    assert _texts(docs.groupBy("id", "part.number").count()) == _texts(once.groupBy("id", "part.number").count())
    assert _texts(canvas.flow_counts(docs)) == _texts(canvas.flow_counts(once))
    for kind, table in canvas.canvas_explode(once).items():
        assert _texts(canvas.canvas_explode(docs)[kind]) == _texts(table)
