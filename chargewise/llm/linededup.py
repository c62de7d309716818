"""Cross-site line removal by distinct-site spread.

A line that occurs on many sites is boilerplate, wherever it stands. Per line hash a HyperLogLog
sketch of the sites is merged by aggregation; lines whose estimate is near the threshold get an exact
distinct count; lines above are removed from every document.

Lines that occur in fewer rows than the threshold, or on one site only, can't spread and never get a
sketch: an exact, cheap pre-aggregation of counts removes nearly all distinct lines first.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from chargewise.llm.common import bounded, slices_of

MIN_SITES = 10
SALTS = 16


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """(row_key, pos, site, k1, k2): one row per non-blank line; k1, k2: 128 bits of the trimmed line."""
    # Keys in a step of their own: beside the generator, each line would have a copy of its whole text hashed.
    keyed = docs.select(_row_key(docs, site), F.col(site).alias("site"), "text")
    at = keyed.select("row_key", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = F.trim("line")
    return at.where(line != "").select("row_key", "pos", "site", F.xxhash64(line).alias("k1"),
                                       F.xxhash64(F.concat(line, F.lit("\n"))).alias("k2"))


def _row_key(docs: DataFrame, site: str) -> Column:
    """Rows that share site and text share the key; what is removed from them is the same."""
    name = F.coalesce(F.col(site).cast("string"), F.lit(""))
    return F.sha2(F.concat_ws(":", F.length(name).cast("string"), name, "text"), 256).substr(1, 32).alias("row_key")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, band: float = 0.25, lg_k: int = 12) -> DataFrame:
    """(k1, k2) of the lines on `min_sites` or more distinct sites.

    Estimates within `band` of the threshold (about 15 standard errors at lg_k = 12) are counted exactly.
    """
    lines = lines.where("site is not null")
    site = F.xxhash64("site")
    often = (lines.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min(site).alias("lo"), F.max(site).alias("hi"))
             .where((F.col("n") >= min_sites) & ((F.col("lo") != F.col("hi")) | F.lit(min_sites <= 1))).select("k1", "k2"))
    # A line may hold a third of all rows: its rows are dealt over SALTS parts, each with a sketch of its own.
    salted = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    suspects = (lines.withColumn("salt", F.pmod(F.xxhash64("row_key", "pos"), F.lit(SALTS)).cast("int"))
                .join(salted, ["k1", "k2", "salt"], "left_semi"))
    spread = (suspects.groupBy("k1", "k2", "salt").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
              .groupBy("k1", "k2").agg(F.hll_union_agg("sketch").alias("sketch"))
              .select("k1", "k2", F.hll_sketch_estimate("sketch").alias("sites")))
    sure = spread.where(F.col("sites") > min_sites * (1 + band)).select("k1", "k2")
    near = spread.where(F.col("sites").between(min_sites * (1 - band), min_sites * (1 + band))).select("k1", "k2")
    exact = (suspects.select("k1", "k2", "site").distinct().join(near, ["k1", "k2"], "left_semi")
             .groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites).select("k1", "k2"))
    return sure.unionByName(exact)


@F.arrow_udf(StringType())      # not "string": that needs a session when the module is imported
def _take_out(texts: pa.Array, drop: pa.Array) -> pa.Array:
    def one(text, at):
        if text is None or at is None:
            return text
        gone = set(at)
        return "\n".join([line for i, line in enumerate(text.split("\n")) if i not in gone])

    parts = [pa.array(list(map(one, *own)), pa.string()) for own in zip(slices_of(texts), slices_of(drop))]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


# Else a caller's filter on the text has it run twice in a task, with a Python worker and a copy of the texts for each.
_without = _take_out.asNondeterministic()


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES,
                       n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """`docs` with boilerplate lines taken out of `text`, and the columns `n_lines` and `n_removed` added.

    Lines are parted by a newline and compared without leading and trailing spaces; blank lines stay.
    A null site is no site, so it spreads nothing, but its rows lose boilerplate lines too. A null
    text stays null, with 0 lines. Repeated rows each count once per row and keep their own result.
    Columns of these two names are replaced, all others kept, whatever they are called; an empty table gives an empty result.
    """
    lines = _lines(bounded(docs), site)
    gone = (lines.join(boilerplate(lines, min_sites), ["k1", "k2"], "left_semi")
            .groupBy("row_key").agg(F.collect_set("pos").alias("gone")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"), _row_key(docs, site))
    joined = rows.join(gone, "row_key", "left")
    lines_of = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    gone_of = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
    kept = [c for c in docs.columns if c not in (n_lines, n_removed)]
    return joined.select(*[_without("text", "gone").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in kept],
                         lines_of.alias(n_lines), gone_of.alias(n_removed))
