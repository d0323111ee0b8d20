import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from visitlake.schemas import CAREGIVER, CARELOG  # noqa: E402
from visitlake.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "2", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


DAY = dt.datetime(2024, 3, 4)  # a Monday


def at(minutes, day=0):
    """A time ``minutes`` after midnight of the given day, None for None."""
    return None if minutes is None else DAY + dt.timedelta(days=day, minutes=minutes)


class Rows:
    """Hand-written visits and the caregivers they need."""

    def __init__(self, spark):
        self.spark, self.visits, self.people = spark, [], {}

    def caregiver(self, who, email=None, status="active"):
        self.people[who] = (
            who, None, "p", "f", "a", None, "First", who, email, None, None, False, None, None, "hired", status
        )
        return self

    def visit(self, who, start=None, end=None, clock_in=None, clock_out=None, note=None, length=None, day=0, known=True):
        if known and who not in self.people:
            self.caregiver(who)
        number = f"V{len(self.visits):05d}"
        self.visits.append((
            number, who, "f", "a", None, at(start, day), at(end, day), at(clock_in, day), at(clock_out, day),
            None, None, "done", False, note, length,
        ))
        return self

    def worked(self, who, minutes, times=1, plan=None, day=0, **more):
        """Visits worked for some minutes, planned for ``plan`` minutes if given."""
        for _ in range(times):
            start, end = (0, plan) if plan is not None else (None, None)
            self.visit(who, start, end, 0, minutes, day=day, **more)
        return self

    def tables(self):
        caregivers = self.spark.createDataFrame(list(self.people.values()), CAREGIVER)
        return caregivers, self.spark.createDataFrame(self.visits, CARELOG)


@pytest.fixture
def rows(spark):
    return Rows(spark)


def by_id(frame, key="caregiverId"):
    return {row[key]: row for row in frame.collect()}
