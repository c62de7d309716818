"""Rule 706: bill-of-lading label violations, in two steps with reviewers between.

Step 1 (`bol_input`) sums the freight charges per PRO (tracking) number for
shipments picked up in the window; reviewers flag violations in that table
and return it. Step 2 (`rule_706`) charges 65 % of the total of each
flagged row.

Inputs: ltl_yw (charges per PRO), ltl (shipment headers), flags (returned table).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargewise import params as P
from chargewise import schemas
from chargewise.functions import dates, money, text
from chargewise.operators import joins
from chargewise.operators.audit import NO_AUDIT, Audit
from chargewise.operators.working_set import materialize


def bol_input(inputs, start: dt.date, end: dt.date, audit: Audit = NO_AUDIT) -> DataFrame:
    """Per PRO number: header attributes (MAX) and charge sums over header x charge rows.

    The source joins headers to charges many-to-many and sums over the joined
    rows, so each charge counts once per header row of its PRO, and a NULL
    part removes a row from the total but not from the single sums. Summing
    each side first and multiplying by the header count gives the same
    numbers without building the product.
    """
    headers = materialize(audit.read(dates.rows_in(inputs["ltl"], "pickup_date", start, end))
                          .groupBy("pro_no")
                          .agg(F.count(F.lit(1)).alias("n_head"),
                               F.max("ltl_po_no").alias("po_max"),
                               F.max("shipper_name").alias("SHIPPER_NAME"),
                               F.max("pickup_date").alias("PICKUP_DATE")))
    charges = (inputs["ltl_yw"]
               .transform(lambda yw: joins.exists_in(yw, headers, "pro_no", written=True))
               .groupBy("pro_no")
               .agg(F.sum("gross").alias("g"), F.sum("fuel").alias("f"), F.sum("acc").alias("a"),
                    F.sum("disc_amt").alias("d"),
                    F.sum(F.col("gross") + F.col("fuel") + F.col("acc")).alias("t")))
    joined = charges.join(headers, "pro_no")
    n = F.col("n_head")
    out = joined.select(
        F.col("pro_no").alias("TRACKING_NUMBER"),
        F.trim(F.upper(F.col("po_max"))).alias("PO_NUMBER"),
        "SHIPPER_NAME", "PICKUP_DATE",
        (F.col("g") * n).alias("GROSS_CHARGE_AMT"),
        (F.col("f") * n).alias("FUEL_SURCHARGE_AMT"),
        (F.col("a") * n).alias("ACCESSORIAL_AMT"),
        (F.col("d") * n).alias("DISC_AMT"),
        (F.col("t") * n).alias("TOTAL_CHARGE_AMT"),
    )
    return schemas.conform(out, schemas.BOL_INPUT)


def rule_706(flags: DataFrame, start: dt.date, end: dt.date, as_of: dt.date | None,
             audit: Audit = NO_AUDIT) -> DataFrame:
    """Charge every flagged row picked up in the window."""
    window = audit.read(flags.filter(dates.within(F.col("PICKUP_DATE"), start, end)))
    rows = audit.exclude(window, F.col("VIOLATE_FLAG") == F.lit(P.VIOLATE), "not flagged")
    feed = rows.select(
        F.lit(P.SITE).alias("SITE"),
        dates.audit_stamp(as_of).alias("AUDIT_TIMESTAMP"),
        F.col("PO_NUMBER"),
        F.lit(P.RULE_706).alias("RULE_NUMBER"),
        F.col("VIOLATE_FLAG"),
        text.comment_706(F.col("TRACKING_NUMBER")).alias("AUDIT_COMMENTS"),
        money.to_feed_amount(money.rate(F.col("TOTAL_CHARGE_AMT"), P.BOL_RATE)).alias("CHARGEBACK_AMOUNT"),
        F.lit(P.ANCHOR).alias("ANCHOR_CONST"),
    )
    return schemas.assert_schema(feed, schemas.feed_schema(P.FEED_706_COLUMNS))
