"""Combine the rule feeds into one finance table.

Takes the feeds by rule id, aligns them on the sorted superset of their
columns (absent columns NULL), unions them (duplicate rows removed when two
or more feeds are combined) and makes the row id unique by suffixing
repeats with '_dup'. The row id is ROW_ID if present, else PO_NUMBER, else
a number in the order of all columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargewise.operators.audit import NO_AUDIT, Audit
from chargewise.operators.dedup import suffix_duplicate_ids
from chargewise.operators.numbering import number_rows
from chargewise.operators.union import aligned_union
from chargewise.plans.runlog import StaleFeeds, stale_feeds
from chargewise.sources.inputs import optional_table
from chargewise.operators.working_set import materialize

COMBINED_TABLE = "DMC_CHARGEBACK_COMBINED"

# The row id is the first of these that the union has; with none, the first is generated.
ID_CANDIDATES = ("ROW_ID", "PO_NUMBER")


def parse_rule_list(rules: str | Sequence[str]) -> list[str]:
    """'702, 710,' -> ['702', '710']; a list without any rule id is an error."""
    parts = rules.split(",") if isinstance(rules, str) else [r or "" for r in rules]
    ids = [part.strip() for part in parts if part.strip()]
    if not ids:
        raise ValueError(f"no rule id in {rules!r}")
    return ids


@dataclass
class CombineResult:
    frame: DataFrame
    merged: list[str]
    skipped: list[str]

    def status(self, target: str = COMBINED_TABLE) -> str:
        """One line for the run's caller: what went in, and which rules had no feed."""
        parts = [f"{target}: {len(self.merged)} feed(s) in", f"rules {' '.join(self.merged)}"]
        if self.skipped:
            parts.append(f"no feed for {' '.join(self.skipped)}")
        return "; ".join(parts)


def combine_frames(feeds: Mapping[str, DataFrame | None], rules: str | Sequence[str], audit: Audit = NO_AUDIT) -> CombineResult:
    """Combine the listed rules' feeds; a rule without a feed is reported as skipped."""
    found: dict[str, DataFrame | None] = {r: feeds.get(r) for r in parse_rule_list(rules)}
    merged, skipped = ([r for r, feed in found.items() if (feed is None) == absent] for absent in (False, True))
    if not merged:
        raise RuntimeError(f"none of the rules {' '.join(skipped)} has a feed")
    df = audit.read(aligned_union([found[r] for r in merged], distinct=False, names=[f"the feed of rule {r}" for r in merged]))
    if len(merged) > 1:                 # a set union; a single feed keeps its repeated rows
        df = audit.without(df, DataFrame.distinct, "repeated row")
    id_col = next((c for c in ID_CANDIDATES if c in df.columns), None)
    if id_col is None:
        # Numbered in the order of all columns: the same rows get the same ids, however they are partitioned.
        id_col = ID_CANDIDATES[0]
        df = number_rows(df, id_col).withColumn(id_col, F.col(id_col).cast("string"))
    # The suffix step reads its input more than once; write the (feed-sized)
    # union once instead of recomputing every rule's feed per read.
    # With two or more feeds the union removed duplicate rows already.
    return CombineResult(suffix_duplicate_ids(materialize(df), id_col, rows_distinct=len(merged) > 1), merged, skipped)


# Rule 706 writes its feed under its own name; the other rules follow the pattern.
RULE_TABLES = {"706": "BOL_706_FINAL_OUTPUT"}


def combine_tables(spark: SparkSession, rules: str | Sequence[str],
                   table_pattern: str = "DMC{rule}_OUT",
                   tables: Mapping[str, str] | None = None, log: DataFrame | None = None,
                   windows: Mapping[str, tuple[dt.date, dt.date]] | None = None, audit: Audit = NO_AUDIT) -> CombineResult:
    """Combine feeds stored as catalog tables.

    With the run log, every feed must be the whole output of its rule's newest run, that run must have succeeded and, where
    `windows` names one, be of that window; else `StaleFeeds` lists what is wrong, and only rules that were never
    published are skipped. Without a log, absent tables are skipped.
    """
    names = {**RULE_TABLES, **(tables or {})}
    found = {r: names.get(r, table_pattern.format(rule=r)) for r in parse_rule_list(rules)}
    if log is not None and (stale := stale_feeds(spark, log, found, windows)):
        raise StaleFeeds(stale)
    return combine_frames({r: optional_table(spark, t) for r, t in found.items()}, rules, audit)
