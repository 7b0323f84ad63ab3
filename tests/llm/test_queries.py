import pytest

import __spark_entry__ as entry
from tallyforge.llm import queries
from tests.test_sql import duck, rows  # noqa: F401


def test_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", ["p3_mixed_jets", "p4_sample", "p7_report", "p8_found", "p8_labels", "p8_kept"])
def test_runs(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() > 0
