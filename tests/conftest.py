from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bancalyt.session import local_session  # noqa: E402
from bancalyt.sources.schema import SCHEMAS  # noqa: E402
from bancalyt.sources.tables import BankTables  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # catalog tables of the tests go to a scratch warehouse, not the repo
    warehouse = tempfile.mkdtemp(prefix="bancalyt-wh-")
    session = local_session(cores=8, shuffle_partitions=8, app="bancalyt-tests",
                            extra={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


def D(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def make_tables(spark, **rows) -> BankTables:
    """BankTables from literal rows; tables not given are empty.

    Keyword names are the logical table names (Clientes=[...], ...)."""
    frames = {
        name: spark.createDataFrame(rows.get(name, []), schema)
        for name, schema in SCHEMAS.items()
    }
    return BankTables.from_mapping(frames)


def collect(df, *cols):
    rows = df.collect()
    if cols:
        return [tuple(r[c] for c in cols) for r in rows]
    return [tuple(r) for r in rows]
