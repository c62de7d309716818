"""Input relations by name.

A rule receives an `Inputs` mapping and reads only the relations it
needs; each is a lazy DataFrame, so Catalyst prunes columns and pushes
the date filters into the scans.

Tables may carry the warehouse's column names (`schemas.SOURCE_COLUMNS`)
or this package's short ones; a table that lacks a column under both names
is an error, never a column of NULLs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargewise import schemas
from chargewise.functions.dates import PARTITION_UNITS


class Inputs(Mapping[str, DataFrame]):
    """Name -> DataFrame, built on first use and then reused."""

    def __init__(self, loaders: Mapping[str, Callable[[], DataFrame]]):
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._loaders[name]()
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._loaders)

    def __len__(self) -> int:
        return len(self._loaders)

    def with_frame(self, name: str, frame: DataFrame) -> Inputs:
        """The same relations with one of them replaced."""
        loaders = dict(self._loaders)
        loaders[name] = lambda: frame
        out = Inputs(loaders)
        out._frames = {k: v for k, v in self._frames.items() if k != name}
        return out


def named(df: DataFrame, relation: str) -> DataFrame:
    """The relation's columns under their short names and declared types, found by source or short name.

    The partition column of a history stored by date (`sources.layout.write_by_date`) stays.
    """
    have = {c.lower(): c for c in df.columns}
    columns, absent = [], []
    for f in schemas.INPUTS[relation].fields:
        source = schemas.SOURCE_COLUMNS[relation][f.name]
        found = have.get(f.name.lower()) or have.get(source.lower())
        if found is None:
            absent.append(f"{f.name} ({source})")
        else:
            columns.append(F.col(f"`{found}`").cast(f.dataType).alias(f.name))
    if absent:
        raise ValueError(f"relation {relation}: no column for {', '.join(absent)}; it has {', '.join(df.columns)}")
    date = schemas.WINDOW_DATE.get(relation)
    return df.select(*columns, *[c for c in df.columns if c in {f"{date}_{unit}" for unit in PARTITION_UNITS}])


def catalog_inputs(spark: SparkSession, tables: Mapping[str, str]) -> Inputs:
    """Relations from catalog tables, e.g. {'fsc': 'edw.freight_shipping_cost'}."""
    return Inputs({name: (lambda n=name, t=table: named(spark.table(t), n)) for name, table in tables.items()})


def parquet_inputs(spark: SparkSession, root: str, names=None) -> Inputs:
    """Relations stored as `<root>/<name>` parquet folders."""
    return Inputs({
        name: (lambda n=name: named(spark.read.parquet(f"{root}/{n}"), n))
        for name in list(names or schemas.INPUTS)
    })


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table if it exists in the catalog (case-insensitive), else None."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def reviewer_flags(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The flag file reviewers send back for rule 706; a CSV with a line that can't be used is an error here, never a
    NULL (`reviewer_file` sets such lines aside instead)."""
    if fmt != "csv":
        return named(spark.read.format(fmt).load(path), "flags")
    read = reviewer_file(spark, path)
    if bad := read.rejects.orderBy("FILE", "LINE_NO").first():
        raise ValueError(f"reviewer file {path}, line {bad['LINE_NO']}: {bad['REASON']}")
    return read.flags


@dataclass
class Reviewed:
    """A returned reviewer file: the rows to charge from, and the lines that can't be used."""

    flags: DataFrame
    rejects: DataFrame | None      # FILE, LINE_NO, RECORD, REASON; None for a file that isn't text


def reviewer_file(spark: SparkSession, path: str, sent: DataFrame | None = None) -> Reviewed:
    """Read the CSV that reviewers return, one record a line, with a header (the declared columns in any order).

    A line that doesn't parse, a value that doesn't fit its column's type, a missing tracking number and, with `sent` (the
    table that went out, `BOL_706_OFFSHORE_INPUT`), a tracking number that wasn't sent or a total that was changed make a
    reject, with its file, line number and reasons; the other rows are read as usual. The header is read once; a wrong one is
    an error, as no row could be trusted. Lines are numbered in parallel, by their splits of the file.
    """
    types = {f.name: f.dataType for f in schemas.INPUTS["flags"].fields}
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("FILE"),
                                         F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    head = lines.filter(F.col("_block") == 0).groupBy("FILE").agg(F.min_by("value", "_at").alias("head")).select("head").distinct().take(2)
    if len(head) != 1:
        raise ValueError(f"reviewer file {path}: {'no header' if not head else 'its parts have different headers'}")
    order = _header(head[0]["head"], types, path)

    # A line's number: its place in its split of the file, after the lines of the splits before.
    split = Window.partitionBy("FILE", "_block").orderBy("_at")
    sizes = lines.groupBy("FILE", "_block").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("FILE", "_block", (F.sum("n").over(Window.partitionBy("FILE").orderBy("_block")) - F.col("n")).alias("_before"))
    numbered = (lines.withColumn("_own", F.row_number().over(split)).join(before, ["FILE", "_block"])
                .select("FILE", (F.col("_before") + F.col("_own")).alias("LINE_NO"), F.col("value").alias("RECORD"))
                .filter((F.col("LINE_NO") > 1) & (F.trim("RECORD") != "")))

    schema = ", ".join(f"`{n}` string" for n in order) + ", _corrupt string"
    parsed = numbered.withColumn("r", F.from_csv("RECORD", F.lit(schema), {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}))

    def value(n):
        if isinstance(types[n], T.DecimalType):         # a third decimal place is no amount, not a rounded one
            fits = F.col(f"r.{n}").try_cast(types[n])
            return F.when(F.col(f"r.{n}").try_cast("decimal(38,10)") == fits, fits)
        return F.col(f"r.{n}") if isinstance(types[n], T.StringType) else F.col(f"r.{n}").try_cast(types[n])

    unfit = [F.when(F.col(f"r.{n}").isNotNull() & value(n).isNull(), F.concat(F.lit(f"{n} is no {types[n].simpleString()}: "), F.col(f"r.{n}")))
             for n in order if not isinstance(types[n], T.StringType)]
    reasons = F.array(F.when(F.col("r._corrupt").isNotNull(), F.lit(f"not {len(order)} columns")), *unfit,
                      F.when(F.coalesce(F.col("r.TRACKING_NUMBER"), F.lit("")) == "", F.lit("no TRACKING_NUMBER")))
    judged = parsed.select("FILE", "LINE_NO", "RECORD", *[value(n).alias(n) for n in types], F.array_compact(reasons).alias("_why"))
    if sent is not None:
        known = sent.select(F.col("TRACKING_NUMBER").alias("_sent"), F.col("TOTAL_CHARGE_AMT").alias("_total")).dropDuplicates(["_sent"])
        judged = judged.join(known, F.col("TRACKING_NUMBER") == F.col("_sent"), "left")
        more = F.array(F.when(F.col("_sent").isNull(), F.lit("this TRACKING_NUMBER was not sent")),
                       F.when(F.col("_sent").isNotNull() & ~F.col("TOTAL_CHARGE_AMT").eqNullSafe(F.col("_total")), F.lit("TOTAL_CHARGE_AMT was changed")))
        judged = judged.withColumn("_why", F.when(F.size("_why") == 0, F.array_compact(more)).otherwise(F.col("_why")))
    good = judged.filter(F.size("_why") == 0).select(*types)
    bad = judged.filter(F.size("_why") > 0).select("FILE", "LINE_NO", "RECORD", F.array_join("_why", "; ").alias("REASON"))
    return Reviewed(good, bad)


def _header(line: str, types: Mapping[str, T.DataType], path: str) -> list[str]:
    """The declared columns in the file's order."""
    by_name = {n.lower(): n for n in types}
    found = [c.strip().strip('"').strip() for c in line.lstrip("\ufeff").split(",")]
    order = [by_name.get(c.lower()) for c in found]
    if sorted(filter(None, order)) != sorted(types) or None in order:
        raise ValueError(f"reviewer file {path}: the columns {', '.join(types)} are expected, its header is {line!r}")
    return order
