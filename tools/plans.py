"""Reading explain() output: where each table scan goes, and what filters it on the way."""

from __future__ import annotations

import contextlib
import io
import re

# explain() shortens scan locations to this many characters; the table name is at their end.
METADATA_LENGTH = "spark.sql.maxMetadataStringLength"
JOINS_AND_EXCHANGES = ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin")


def plan_text(df, mode: str | None = None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


def scans(plan: str, stops=JOINS_AND_EXCHANGES) -> list[tuple[str, str, list[str]]]:
    """For each parquet scan of a plan: table, the first of `stops` above it ("-" if none), the plan's lines between."""
    lines = plan.split("\n")
    out = []
    for i, line in enumerate(lines):
        m = re.search(r"FileScan parquet .*?/([\w-]+)\]", line)
        if not m:
            continue
        depth, between, above = _depth(line), [], "-"
        for j in range(i - 1, -1, -1):
            if _depth(lines[j]) < depth:
                depth = _depth(lines[j])
                node = lines[j].strip(" :+-").split(" ")[0].split("(")[0]
                if node in stops:
                    above = node
                    break
                between.append(lines[j].strip(" :+-"))
        out.append((m.group(1), above, between))
    return out


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))
