"""SQL statements that recompute every query with another engine."""

from verification.loads import STATEMENTS as _LOADS
from verification.reports import STATEMENTS as _REPORTS

STATEMENTS = {**_REPORTS, **_LOADS}
