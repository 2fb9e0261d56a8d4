"""Reports and rules from merged summaries; each has the SQL of the report over the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.catalog.base import LAYOUT, REGISTRY, Tables, query
from daymark.catalog.quality import DIRTY, RULES
from daymark.operators import quality, summary


def merged(wide: DataFrame) -> summary.Summary:
    """The summary of a table from those of three loads that share days and points."""
    part = F.pmod(F.xxhash64(*wide.columns), F.lit(3))
    loads = [summary.summarize(wide.filter(part == i), LAYOUT) for i in range(3)]
    return summary.merge(summary.merge(loads[0], loads[1]), loads[2])


def _register(report: str, table: str) -> None:
    known = REGISTRY[f"profile_{report}"]

    @query(f"summary_{report}", known.oracle, known.doubles)
    def _(t: Tables):
        return getattr(summary, report)(merged(getattr(t, table)))


for _report, _table in (("temporal_coverage", "w2"), ("points", "d1"), ("coordinate_variants", "d1"),
                        ("missing", "d1"), ("date_gaps", "d1"), ("rule_violations", "d1"),
                        ("location_counts", "w2"), ("annual_counts", "w2"), ("candidate_problems", "d1"),
                        ("bounding_box", "w2"), ("location_stats", "w2"), ("sources", "d1"),
                        ("coverage", "w2"), ("missing_measures", "d1")):
    _register(_report, _table)


@query("summary_rule_rows", f"{DIRTY} " + " UNION ALL ".join(RULES[r] for r in quality.ROW_RULES))
def _(t: Tables):
    return summary.rule_rows(merged(t.d1))
