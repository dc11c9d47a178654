import math
from collections import Counter

import duckdb
import pytest

from tapeworks import config
from tapeworks.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 6) if isinstance(v, float) and math.isfinite(v) else v
    return Counter(tuple(plain(row[i]) for i in order) for row in values)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, sql, name):
    got = registry.queries()[name](spark, SF)
    values = [tuple(r) for r in got.collect()]
    if name in registry.oracle_sql():
        found = sql.execute(registry.oracle_sql()[name])
        columns = [d[0] for d in found.description]
        assert sorted(columns) == sorted(got.columns)
        assert rows(columns, found.fetchall()) == rows(got.columns, values)
    else:
        assert values


@pytest.mark.parametrize("name", ["data_quality_of_raw", "column_checks", "stage_trades", "type_trades"])
def test_events_may_have_synthetic_ids(spark, tmp_path, name):
    """Long tables reach the ids that the model knows as synthetic: here they are events like others."""
    con = duckdb.connect()
    ids = ", ".join(f"({i})" for i in config.SYNTHETIC_TRADE_IDS)
    con.execute(f"""copy (select * from '{SF}/events.parquet' union all select s.i, ts, user_id, 'view', value, '{{"k": 21}}' from (values {ids}) s(i), (select * from '{SF}/events.parquet' where event_id = 7)) to '{tmp_path}/events.parquet'""")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    got = registry.queries()[name](spark, str(tmp_path))
    found = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert rows(columns, found.fetchall()) == rows(got.columns, [tuple(r) for r in got.collect()])


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
