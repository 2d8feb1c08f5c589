import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourgrid.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # plan-shape tests read whole plan strings; Spark takes at most 2147483632 here
    s = local_session("*", shuffle_partitions=8, app="hourgrid-tests",
                      extra={"spark.sql.maxPlanStringLength": "2000000000"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return con
