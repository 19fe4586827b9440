"""Every registered query of the ledger builds and runs to its end."""

import pytest

from walletyield.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_runs(spark, name):
    df = catalog.queries()[name](spark, SF)
    assert df.columns
    df.write.format("noop").mode("overwrite").save()
