"""Every query against its check statement on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from verification.compare import compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


# the training text operators are tested by themselves
OWN = sorted(name for name in entry.queries() if not name.startswith("op") and name != "pipeline")


def test_every_query_has_a_statement():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(OWN) == 53


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    line = compare(spark, duck, SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ": ok" in line, line


def test_flagship(spark):
    assert entry.entry(spark).count() == 50


def test_data_reaches_the_labels(spark):
    """The derived tables exercise the ladders; values no input can reach stay at zero."""
    queries = entry.queries()

    def seen(name, column):
        return {r[0] for r in queries[name](spark, SF_DIR).select(column).distinct().collect()}

    assert seen("duration_flags", "data_quality_flag") == {
        "MISSING_CLOCK_IN", "MISSING_CLOCK_OUT", "INVALID_DURATION", "EXCESSIVE_DURATION", "TOO_SHORT_DURATION", "VALID_DURATION",
    }
    assert seen("comment_categories", "comment_category") == {"VERY_SHORT", "SHORT", "MEDIUM", "LONG", "VERY_LONG"}
    assert seen("doc_anomalies", "anomaly_type") == {
        "VERY_SHORT_DOCUMENTATION", "SHORT_DOCUMENTATION", "EXCESSIVELY_LONG", "GENERIC_COMMENT",
        "SUSPECTED_COPY_PASTE", "DUPLICATE_CONTENT_SUSPECTED", "TOO_GENERIC", "NORMAL_DOCUMENTATION",
    }
    assert seen("overtime_rows", "time_period") == {"EARLY_MORNING", "MORNING", "AFTERNOON", "EVENING"}
    assert any(v > 0 for v in seen("overtime_rows", "overtime_percentage"))
