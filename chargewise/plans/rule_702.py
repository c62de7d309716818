"""Rule 702: expedited shipments.

A shipment ordered as ground is charged when its carrier invoice shows a
non-ground FedEx service or a non-ground UPS zone. Charge = |freight + 20|.

Inputs: fsc (freight cost per shipped line), oms_line, fdx, ups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargewise import params as P
from chargewise import schemas
from chargewise.functions import dates, money, text
from chargewise.operators import joins, predicates as pred
from chargewise.operators.audit import NO_AUDIT, Audit
from chargewise.operators.working_set import materialize

AUDIT_COLUMNS = (
    "PO_NUMBER", "ORDER_NO", "ORDER_DATE", "OMS_ORDER_LINE_SCAC",
    "OMS_ORDER_LINE_CARRIER_SERVICE_CODE", "SHIPMENT_SHIP_NODE", "SCAC", "TRACKING_NUMBER",
    "TRANS_AMT", "CHARGEBACK_AMOUNT", "SC_FDX_SERVICE_TYPE", "SC_UPS_ZONE",
)


def expedited_audit(inputs, start: dt.date, end: dt.date,
                    p: P.Rule702Params = P.Rule702Params(), audit: Audit = NO_AUDIT) -> DataFrame:
    """Distinct ground-ordered shipments in the window with a non-ground invoice."""
    # The window's freight rows are a small slice of the freight history; written
    # first, their real size decides between broadcasting them against the line
    # and invoice histories and a shuffled join (with bloom-filtered history scans).
    # A parcel without a tracking number has no invoice, so nothing can charge it.
    window = audit.read(dates.rows_in(inputs["fsc"], "order_date", start, end))
    freight = materialize(audit.exclude(window, F.col("po").isNotNull() & F.col("trk").isNotNull(), "no PO or tracking number")
                          .select("po", "order_no", "order_date", "line_key", "scac", "trk", "trans_amt"))
    # Left join + a filter on the line's service code = inner join.
    # Line and invoice histories cut to the window's keys by semi joins (no history
    # shuffle); the invoice joins are left outer, which could not broadcast the
    # small freight side. Each cut is written: a task that hashes a join's side carries the plan below it with the
    # key filters of all its histories, and the driver holds that several times over.
    ground_lines = materialize(joins.exists_in(inputs["oms_line"], freight, "line_key", written=True)
                               .filter(F.col("carrier_service").isin(list(p.ground_service_codes)))
                               .select(F.col("line_key").alias("ol_line_key"), "line_scac", "carrier_service", "ship_node"))
    # Only the type and the zone are read, under a DISTINCT: an invoice repeated m times
    # met with one repeated n times would be m x n rows.
    fdx = materialize(joins.exists_in(inputs["fdx"], freight, "trk", written=True)
                      .select(F.col("trk").alias("fdx_trk"), "svc").distinct())
    ups = materialize(joins.exists_in(inputs["ups"], freight, "trk", written=True)
                      .select(F.col("trk").alias("ups_trk"), "zone").distinct())
    joined = (freight
              .join(ground_lines, F.col("line_key") == F.col("ol_line_key"), "inner")
              .join(fdx, F.col("trk") == F.col("fdx_trk"), "left")
              .join(ups, F.col("trk") == F.col("ups_trk"), "left"))
    joined = audit.exclude(joined, pred.outside_either(F.col("svc"), p.fedex_ground_types, F.col("zone"), p.ups_ground_zones),
                           "no invoice above ground")
    return joined.select(
        F.col("po").alias("PO_NUMBER"), F.col("order_no").alias("ORDER_NO"),
        F.col("order_date").alias("ORDER_DATE"), F.col("line_scac").alias("OMS_ORDER_LINE_SCAC"),
        F.col("carrier_service").alias("OMS_ORDER_LINE_CARRIER_SERVICE_CODE"),
        F.col("ship_node").alias("SHIPMENT_SHIP_NODE"), F.col("scac").alias("SCAC"),
        F.col("trk").alias("TRACKING_NUMBER"), F.col("trans_amt").alias("TRANS_AMT"),
        (F.col("trans_amt") + F.lit(P.FREIGHT_OFFSET)).alias("CHARGEBACK_AMOUNT"),
        F.col("svc").alias("SC_FDX_SERVICE_TYPE"), F.col("zone").alias("SC_UPS_ZONE"),
    ).distinct()


def feed_from_audit(rows: DataFrame, as_of: dt.date | None,
                    p: P.Rule702Params = P.Rule702Params(), audit: Audit = NO_AUDIT) -> DataFrame:
    """Charge the audit rows: excluded nodes and zero (or NULL) amounts drop out.

    The 8 feed columns are taken without a second DISTINCT, so two audit rows
    that differ only in dropped columns give two equal feed rows.
    """
    kept = audit.exclude(rows, pred.text_not_in_dropping_null(F.col("SHIPMENT_SHIP_NODE"), p.excluded_ship_nodes), "ship node")
    kept = audit.exclude(kept, pred.differs_dropping_null(F.col("CHARGEBACK_AMOUNT"), 0), "no amount")
    feed = kept.select(
        dates.audit_stamp(as_of).alias("AUDIT_TIMESTAMP"),
        F.col("PO_NUMBER"),
        F.lit(P.RULE_702).alias("RULE_NUMBER"),
        F.lit(P.VIOLATE).alias("VIOLATE_FLAG"),
        text.comment_702(F.col("TRACKING_NUMBER")).alias("AUDIT_COMMENTS"),
        money.to_feed_amount(F.abs(F.col("CHARGEBACK_AMOUNT"))).alias("CHARGEBACK_AMOUNT"),
        F.lit(P.ANCHOR).alias("ANCHOR_CONSTANT"),
        F.lit(P.SITE).alias("SITE"),
    )
    return schemas.assert_schema(feed, schemas.feed_schema(P.FEED_702_COLUMNS))


def rule_702(inputs, start: dt.date, end: dt.date, as_of: dt.date | None,
             p: P.Rule702Params = P.Rule702Params(), audit: Audit = NO_AUDIT) -> DataFrame:
    return feed_from_audit(expedited_audit(inputs, start, end, p, audit), as_of, p, audit)
