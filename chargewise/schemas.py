"""Explicit schemas of the 19 input relations and of every output.

Input names are short forms of the warehouse views the rules read; the
docstring of each rule names the columns it uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
S, D, TS, L, I = T.StringType(), T.DateType(), T.TimestampNTZType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


INPUTS: dict[str, T.StructType] = {
    # freight shipping cost (one row per shipped order line)
    "fsc": _struct(("po", S), ("order_no", S), ("order_date", D), ("line_key", S),
                   ("scac", S), ("trk", S), ("trans_amt", MONEY)),
    # FedEx and UPS invoices, keyed by tracking number
    "fdx": _struct(("trk", S), ("svc", S)),
    "ups": _struct(("trk", S), ("zone", S)),
    # calendar
    "time_dim": _struct(("cal_date", D)),
    # order management: orders, lines, ship nodes
    "oms_order": _struct(("order_key", S), ("order_no", S), ("order_ts", TS), ("doc_type", S)),
    "oms_line": _struct(("line_key", S), ("order_key", S), ("chain_order_key", S),
                        ("chain_line_key", S), ("item_id", S), ("ship_node", S),
                        ("unit_price", MONEY), ("orig_qty", MONEY), ("cat", S),
                        ("order_ts", TS), ("carrier_service", S), ("line_scac", S)),
    "ship_node": _struct(("ship_node", S), ("node_desc", S)),
    # release status history and status dimension
    "rel_status": _struct(("status_key", S), ("release_key", S), ("line_key", S),
                          ("order_key", S), ("sched", S), ("status", S),
                          ("status_ts", TS), ("qty", MONEY)),
    "status_dim": _struct(("status", S), ("descr", S), ("ptype", S)),
    # order audit reasons, order notes, cancelled lines
    "audit": _struct(("order_key", S), ("code", S), ("text", S)),
    "note": _struct(("table_key", S), ("code", S), ("txt", S)),
    "cancel_line": _struct(("line_key", S), ("create_ts", TS), ("cancel_qty", MONEY),
                           ("code", S), ("note", S)),
    # purchasing: PO lines and their dimensions
    "po_line": _struct(("po_no", S), ("article_no", S), ("price", MONEY),
                       ("deliv_date", D), ("store_no", I), ("vendor_id", L)),
    "store": _struct(("store_no", I), ("chan", I)),
    "article": _struct(("article_no", S)),
    "vendor": _struct(("vendor_id", L)),
    # less-than-truckload shipments: charges and headers
    "ltl_yw": _struct(("pro_no", S), ("gross", MONEY), ("fuel", MONEY), ("acc", MONEY),
                      ("disc_amt", MONEY)),
    "ltl": _struct(("pro_no", S), ("ltl_po_no", S), ("shipper_name", S), ("pickup_date", D)),
    # reviewer flags returned for rule 706
    "flags": _struct(("TRACKING_NUMBER", S), ("PO_NUMBER", S), ("TOTAL_CHARGE_AMT", MONEY),
                     ("VIOLATE_FLAG", S), ("PICKUP_DATE", D)),
}

# The date of each relation that a reporting window bounds.
WINDOW_DATE: dict[str, str] = {"rel_status": "status_ts", "fsc": "order_date", "ltl": "pickup_date"}

# The warehouse's name of each column.
SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "fsc": {"po": "PO_ORDER_NO", "order_no": "ORDER_NO", "order_date": "ORDER_DATE", "line_key": "ORDER_LINE_KEY",
            "scac": "SCAC", "trk": "TRACKING_NO", "trans_amt": "TRANS_AMT"},
    "fdx": {"trk": "SC_FDX_EXPRESS_OR_GROUND_TRACKING_ID", "svc": "SC_FDX_SERVICE_TYPE"},
    "ups": {"trk": "SC_UPS_TRACKING_NO", "zone": "SC_UPS_ZONE"},
    "time_dim": {"cal_date": "CAL_DATE"},
    "oms_order": {"order_key": "OMS_ORDER_KEY", "order_no": "OMS_ORDER_NO", "order_ts": "OMS_ORDER_TS", "doc_type": "OMS_DOC_TYPE"},
    "oms_line": {"line_key": "OMS_ORDER_LINE_KEY", "order_key": "OMS_ORDER_KEY", "chain_order_key": "OMS_CHAIN_ORDER_KEY",
                 "chain_line_key": "OMS_CHAIN_ORDER_LINE_KEY", "item_id": "OMS_ITEM_ID", "ship_node": "OMS_SHIP_NODE_KEY",
                 "unit_price": "OMS_ORDER_LINE_UNIT_PRICE", "orig_qty": "OMS_ORDER_LINE_ORIG_ORDER_QTY",
                 "cat": "OMS_ITEM_CAT_CODE", "order_ts": "OMS_ORDER_TS",
                 "carrier_service": "OMS_ORDER_LINE_CARRIER_SERVICE_CODE", "line_scac": "OMS_ORDER_LINE_SCAC"},
    "ship_node": {"ship_node": "OMS_SHIP_NODE_KEY", "node_desc": "OMS_SHIP_NODE_DESC"},
    "rel_status": {"status_key": "OMS_ORDER_RELEASE_STATUS_KEY", "release_key": "OMS_ORDER_RELEASE_KEY",
                   "line_key": "OMS_ORDER_LINE_KEY", "order_key": "OMS_ORDER_KEY", "sched": "OMS_ORDER_LINE_SCHEDULE_KEY",
                   "status": "OMS_ORDER_RELEASE_STATUS", "status_ts": "OMS_ORDER_RELEASE_STATUS_TS",
                   "qty": "OMS_ORDER_RELEASE_STATUS_TOTAL_QTY"},
    "status_dim": {"status": "OMS_STATUS", "descr": "OMS_STATUS_DESC", "ptype": "OMS_PROCESS_TYPE_KEY"},
    "audit": {"order_key": "OMS_ORDER_KEY", "code": "OMS_ORDER_AUDIT_RESN_CODE", "text": "OMS_ORDER_AUDIT_RESN_TEXT"},
    "note": {"table_key": "OMS_TABLE_KEY", "code": "OMS_NOTE_RESN_CODE", "txt": "OMS_NOTE_TEXT"},
    "cancel_line": {"line_key": "OMS_ORDER_LINE_KEY", "create_ts": "OMS_CREATE_TS", "cancel_qty": "OMS_ORDER_CANCEL_QTY",
                    "code": "OMS_ORDER_CANCEL_RESN_CODE", "note": "OMS_ORDER_CANCEL_RESN_NOTE"},
    "po_line": {"po_no": "PO_NO", "article_no": "ARTICLE_NO", "price": "PO_LINE_UNIT_PRICE", "deliv_date": "DELIV_DATE",
                "store_no": "STORE_NO", "vendor_id": "VENDOR_ID"},
    "store": {"store_no": "STORE_NO", "chan": "DISTB_CHAN_CODE"},
    "article": {"article_no": "ARTICLE_NO"},
    "vendor": {"vendor_id": "VENDOR_ID"},
    "ltl_yw": {"pro_no": "PRO_NO", "gross": "GROSS_CHARGE_AMT", "fuel": "FUEL_SURCHARGE_AMT", "acc": "ACCESSORIAL_AMT",
               "disc_amt": "DISC_AMT"},
    "ltl": {"pro_no": "PRO_NO", "ltl_po_no": "LTL_PO_NO", "shipper_name": "SHIPPER_NAME", "pickup_date": "PICKUP_DATE"},
    "flags": {c: c for c in ("TRACKING_NUMBER", "PO_NUMBER", "TOTAL_CHARGE_AMT", "VIOLATE_FLAG", "PICKUP_DATE")},
}

_FEED_TYPES = {
    "AUDIT_TIMESTAMP": S, "PO_NUMBER": S, "RULE_NUMBER": S, "VIOLATE_FLAG": S,
    "AUDIT_COMMENTS": S, "CHARGEBACK_AMOUNT": T.DoubleType(), "ANCHOR_CONSTANT": S,
    "ANCHOR_CONST": S, "SITE": I,
}


def feed_schema(columns: tuple[str, ...]) -> T.StructType:
    return _struct(*((c, _FEED_TYPES[c]) for c in columns))


BOL_INPUT = _struct(("TRACKING_NUMBER", S), ("PO_NUMBER", S), ("SHIPPER_NAME", S),
                    ("PICKUP_DATE", D), ("GROSS_CHARGE_AMT", MONEY),
                    ("FUEL_SURCHARGE_AMT", MONEY), ("ACCESSORIAL_AMT", MONEY),
                    ("DISC_AMT", MONEY), ("TOTAL_CHARGE_AMT", MONEY))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def columns_and_types(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    """(name, type) pairs; nullability is left out (Spark infers it per plan)."""
    return [(f.name, f.dataType) for f in schema.fields]


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    got, want = columns_and_types(df.schema), columns_and_types(schema)
    if got != want:
        raise AssertionError(f"schema mismatch:\n got  {got}\n want {want}")
    return df
