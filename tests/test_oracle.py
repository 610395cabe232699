"""Every registered query beside its SQL in DuckDB, on the smallest given tables."""
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parent.parent / "tools"))
import check  # noqa: E402

from geotally.plans import catalog  # noqa: E402

DATA, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE

pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="given tables are absent")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    status, _, _, message = check.compare(spark, DATA, name, QUERIES[name], ORACLE.get(name))
    if status == "EMPTY":  # too little data for any row: the next size has some
        status, _, _, message = check.compare(spark, LARGER, name, QUERIES[name], ORACLE.get(name))
    assert status == "OK", f"{status}: {message}"


def test_names_agree():
    assert set(ORACLE) == set(QUERIES)
