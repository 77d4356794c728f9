"""Every registered query against its SQL counterpart, on the smallest tables."""

import pytest
from compare import compare, duck

import __spark_entry__ as contract
from marquee.catalog.oracles import ORACLES
from marquee.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_contract():
    assert set(ORACLES) == set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    compare(spark, connection, name, contract.queries()[name], contract.oracle_sql()[name], sf_dir)


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 13 and df.count() > 0


def test_state_documents_and_title_files_follow_the_rows(spark, sf_dir, connection, monkeypatch):
    from pathlib import Path

    from marquee import session
    from marquee.catalog import queries

    monkeypatch.setattr(queries, "STATE_ROWS", 2)
    raw = queries.t.raw_titles(spark, sf_dir)
    monkeypatch.setattr(queries.t, "raw_titles", lambda *_: raw.repartition(3))
    for name in ("state_json", "title_files"):
        compare(spark, connection, name, QUERIES[name], ORACLES[name], sf_dir)
    state, _, titles = session._scratch[spark.sparkContext.applicationId][-3:]
    assert len(list(Path(state).glob("file=d*"))) > 16
    assert len(list(Path(titles).glob("part=a/*.csv"))) == 3


def test_landed_files_follow_the_bytes_in_as_many_batches(spark, sf_dir, connection, monkeypatch):
    """More bytes land as more files, never as larger ones, in the query's own number of batches."""
    from pathlib import Path

    from marquee.catalog import queries

    monkeypatch.setattr(queries, "LANDED_BYTES", 20_000)
    run, seen = queries.Drain.run_landed, []

    def counted(self, path):
        seen.append((len(list(Path(path).glob("*.parquet"))), self.cfg.checkpoint_rows))
        return run(self, path)

    monkeypatch.setattr(queries.Drain, "run_landed", counted)
    for name, batches, least in LANDED:
        seen.clear()
        compare(spark, connection, name, QUERIES[name], ORACLES[name], sf_dir)
        for files, each in seen:
            assert files > least and each > least // batches
            assert -(-files // each) == batches
        assert seen


# Query, micro-batches, files at least.
LANDED = [("drain_repeated", 3, 3), ("drain_stream", 2, 4), ("drain_retry_state", 2, 4)]
