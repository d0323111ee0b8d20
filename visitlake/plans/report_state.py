"""Report figures kept beside the stored visits, brought up to date by new files only.

``sync`` reduces the visits of data files not taken in yet to the parts of every report
(see ``figures``), and stores them as a batch. Reports over the state add the parts of
all batches, and read no visit. A batch counts once a row of ``covered`` names it with
its files, and that is written last and as one file: after a load or a ``sync`` that was
interrupted the next one takes the files in as if nothing had been written.

One ``sync`` runs at a time, as one load does. When a covered file is gone, because the
table was rewritten, everything is reduced anew. Many small batches are put together
into one. Both write a new generation; the owner of the folder removes earlier ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from visitlake.operators.figures import Figures
from visitlake.plans import documentation, duration, overtime, performance, reliability
from visitlake.sources.tables import append, read_table, table_path

#: A row per data file taken in, with the batch that holds it.
COVERED = "generation int, batch string, file string"
#: More batches than these are put together into one.
MOST_BATCHES = 64

#: Reports on the same visits share a part, so that these are read and reduced once for both.
SHARED: dict[str, tuple[Figures, Figures]] = {
    figures.name: (figures, part)
    for figures, part in (
        (reliability.FIGURES, reliability.FIGURES), (performance.FIGURES, performance.FIGURES),
        (documentation.COMMENT_DETAIL, documentation.DOCUMENTATION), (documentation.DOC_SUSPICION, documentation.DOCUMENTATION),
        (overtime.OVERTIME, overtime.ALL_OVERTIME), (overtime.INSIGHT, overtime.ALL_OVERTIME),
    )
}
#: By report; the name is that of the part.
FIGURES: dict[str, Figures] = {
    name: replace(part, days=figures.days, months=figures.months) for name, (figures, part) in SHARED.items()
}
#: Where parts are kept that have these names and columns; a state of another layout is left alone.
LAYOUT = "layout-2"


@dataclass(frozen=True)
class Kept:
    """How a stored part is made of visits, and how the parts of several batches add up to one."""

    parts: Callable[[DataFrame], DataFrame]
    added: Callable[[DataFrame], DataFrame]


KEPT: dict[str, Kept] = {
    **{figures.name: Kept(figures.parts, figures.added) for figures in FIGURES.values()},
    "duration_minutes": Kept(duration.minute_parts, duration.minutes_added),
    "duration_values": Kept(duration.value_parts, duration.values_added),
}


class ReportState:
    """The state beside table ``table`` of a warehouse folder."""

    def __init__(self, spark: SparkSession, warehouse: str, table: str = "carelog", most_batches: int = MOST_BATCHES):
        self.spark, self.warehouse, self.table, self.most_batches = spark, warehouse, table, most_batches
        self.home = f"{table_path(warehouse, 'report_state')}/{LAYOUT}/{table}"
        self._load()

    def _load(self) -> None:
        """What is taken in: one small job, with a row per data file of the table."""
        like = self.spark.createDataFrame([], COVERED)
        rows = list(read_table(self.spark, self.home, "covered", like=like).toLocalIterator())
        self.generation = max((r["generation"] for r in rows), default=0)
        self.batch_of = {r["file"]: r["batch"] for r in rows if r["generation"] == self.generation}

    @property
    def batches(self) -> list[str]:
        return sorted(set(self.batch_of.values()))

    def _paths(self, name: str) -> list[str]:
        return [f"{self.home}/{name}/{batch}" for batch in self.batches]

    def _cover(self, generation: int, batch: str, files: list[str]) -> None:
        rows = [(generation, batch, f) for f in files]
        append(self.spark.createDataFrame(rows, COVERED).coalesce(1), self.home, "covered")
        self._load()

    def _store(self, parts: dict[str, DataFrame]) -> str:
        batch = uuid.uuid4().hex
        for name, rows in parts.items():
            rows.write.parquet(f"{self.home}/{name}/{batch}")
        return batch

    def sync(self) -> ReportState:
        """Take in the visits of files not known yet; returns the state."""
        stored = read_table(self.spark, self.warehouse, self.table)
        files = {f.rsplit("/", 1)[-1]: f for f in stored.inputFiles()}
        generation = self.generation
        if self.batch_of.keys() - files.keys():
            generation, self.batch_of = generation + 1, {}
        new = sorted(files.keys() - self.batch_of.keys())
        if new:
            visits = self.spark.read.schema(stored.schema).parquet(*[files[f] for f in new])
            self._cover(generation, self._store({name: kept.parts(visits) for name, kept in KEPT.items()}), new)
        if len(self.batches) > self.most_batches:
            self.compact()
        return self

    def compact(self) -> None:
        """Put all batches together into one, in a new generation."""
        batch = self._store({name: kept.added(self.parts(name)) for name, kept in KEPT.items()})
        self._cover(self.generation + 1, batch, sorted(self.batch_of))

    def parts(self, name: str) -> DataFrame:
        """The stored parts of all batches; those of no visits if there is none."""
        if not self.batch_of:
            return KEPT[name].parts(read_table(self.spark, self.warehouse, self.table).where("1 = 0"))
        paths = self._paths(name)
        return self.spark.read.schema(self.spark.read.parquet(paths[0]).schema).parquet(*paths)

    def figures(self, name: str) -> DataFrame:
        """The figures of a report, one row per caregiver."""
        return FIGURES[name].of_parts(self.parts(FIGURES[name].name))

    def report(self, name: str, caregivers: DataFrame, **limit: int | None) -> DataFrame:
        """A report by name, equal to the one over all visits taken in."""
        if name == "visit_duration":
            minutes, values = (KEPT[k].added(self.parts(k)) for k in ("duration_minutes", "duration_values"))
            return duration.visit_duration_of(caregivers, minutes, values, **limit)
        return REPORTS[name](caregivers, self.figures(name), **limit)


REPORTS: dict[str, Callable[..., DataFrame]] = {
    "reliability": reliability.reliability_of,
    "top_performance": performance.top_performance_of,
    "comment_detail": documentation.comment_detail_of,
    "doc_suspicion": documentation.doc_suspicion_of,
    "overtime": overtime.overtime_of,
    "overtime_insight": overtime.overtime_insight_of,
}
