"""Rule 710: purchase-order lines cancelled outside the service level.

A drop-ship PO line whose top release status is 'cancelled' in the window
is charged 3 % of its item cost, unless the PO carries an exempting note,
the cancel reason is REMORSE (or missing), or the order audit / cancel note
gives an excluded reason.

Inputs: rel_status, status_dim, oms_line, oms_order, time_dim, ship_node,
audit, note, cancel_line, po_line, store, article, vendor.

Shared sub-results (both the exemption list and the candidates use them):
  * top status per line (`top_status`),
  * lines with a '1100' (created) status row (`created_lines`),
  * the latest cancel record per line (`latest_cancel`).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargewise import params as P
from chargewise import schemas
from chargewise.functions import dates, money, text
from chargewise.operators import joins, predicates as pred
from chargewise.operators.audit import NO_AUDIT, Audit
from chargewise.operators.ranking import latest_with_total, top_ties
from chargewise.operators.working_set import materialize
from chargewise.plans.top_state import competing

COST = "decimal(18,4)"

EXEMPT_COLUMNS = ("STATUS_DATE", "PO_ORDER_NO", "ORDER_NO", "DSV_EXCEPTION")
CANCEL_COLUMNS = (
    "ORDER_DATE", "STATUS_DATE", "PO_ORDER_NO", "ORDER_NO", "OMS_ITEM_ID",
    "OMS_ORDER_LINE_UNIT_PRICE", "STATUS_QTY", "DEMAND_QTY", "DEMAND_SALES",
    "OMS_ORDER_RELEASE_STATUS", "OMS_STATUS_DESC", "OMS_ORDER_AUDIT_RESN_CODE",
    "OMS_ORDER_AUDIT_RESN_TEXT", "OMS_ORDER_CANCEL_RESN_CODE", "OMS_ORDER_CANCEL_RESN_NOTE",
    "OMS_SHIP_NODE_KEY", "OMS_SHIP_NODE_DESC", "ITEM_COST",
)
TOP_STATUS_COLUMNS = {
    "RCO": "rco", "OMS_ORDER_RELEASE_STATUS": "status", "OMS_STATUS_DESC": "descr",
    "OMS_ORDER_NO": "order_no", "OMS_ITEM_ID": "item_id", "OMS_ORDER_LINE_KEY": "line_key",
    "OMS_ORDER_RELEASE_STATUS_TS": "status_ts", "OMS_ORDER_RELEASE_STATUS_KEY": "status_key",
    "OMS_ORDER_LINE_SCHEDULE_KEY": "sched", "OMS_ORDER_RELEASE_KEY": "release_key",
    "OMS_ORDER_KEY": "order_key", "OMS_ORDER_RELEASE_STATUS_TOTAL_QTY": "qty",
    "OMS_DOC_TYPE": "doc_type",
}

# The columns of a top-status row, and those of them that the rule reads.
RANKED_COLUMNS = ("status", "descr", "order_no", "item_id", "line_key", "status_ts", "status_key", "sched", "release_key",
                  "order_key", "qty", "doc_type")
NARROW_COLUMNS = ("status", "descr", "line_key", "status_ts", "qty")
# What the rule reads of the status and line histories; the other columns stay out of the window's slices and their shuffles.
STATUS_COLUMNS = ("line_key", "order_key", "sched", "status", "status_ts", "qty")
LINE_COLUMNS = ("line_key", "order_key", "chain_order_key", "chain_line_key", "cat", "item_id", "ship_node", "unit_price",
                "orig_qty", "order_ts")

# Whole histories are ranked line by line, but for lines (counted by buckets of their hashed keys) with more status rows than a
# task should take. At most so many buckets are named in a filter.
LINE_BUCKETS = 1 << 16
HOT_ROWS = 100_000
HOT_BUCKETS = 1000


# ---------------------------------------------------------------------------
# Shared sub-results
# ---------------------------------------------------------------------------

def lines_active_in(inputs, start: dt.date, end: dt.date, audit: Audit = NO_AUDIT) -> DataFrame:
    """Line keys with at least one release-status row dated in the window."""
    window = audit.read(dates.rows_in(inputs["rel_status"], "status_ts", start, end))
    return window.select("line_key").distinct()


def with_line_and_order(inputs, status_rows: DataFrame, how: str = "inner",
                        lines: DataFrame | None = None, orders: DataFrame | None = None) -> DataFrame:
    """Status rows with their line's item and order time and their PO order's number.

    With `how="left"` every status row is kept (attributes NULL when the line or
    the PO order is missing), so one frame serves both the ranking (rows with
    both matches) and the created-row lookup (all rows). `lines` / `orders`
    replace the full tables by slices already cut to the keys at hand.
    """
    lines = (lines if lines is not None else inputs["oms_line"]).select(
        F.col("line_key").alias("_ol_line"), "item_id", F.col("order_ts").alias("_ol_ts"))
    orders = (orders if orders is not None else inputs["oms_order"])
    orders = (orders.filter(F.col("doc_type") == P.PO_DOC_TYPE)
              .select(F.col("order_key").alias("_ord_key"), "order_no", "doc_type"))
    return (status_rows.join(lines, F.col("line_key") == F.col("_ol_line"), how)
                       .join(orders, F.col("order_key") == F.col("_ord_key"), how))


def rank_top_status(inputs, rows: DataFrame, narrow: bool = False) -> DataFrame:
    """Per PO line: the status rows with the greatest status code among the rows
    sitting at some schedule's latest timestamp (ties kept).

    `rows` are status rows joined to their line and PO order
    (`with_line_and_order`). A status row competes when its timestamp equals
    the latest timestamp of any schedule of its line; it appears once per such
    schedule (the join is on line and timestamp, not on the schedule). Lines
    whose order date is not on the calendar have no latest timestamp and drop out.

    `narrow`: only `NARROW_COLUMNS` of the top rows are asked for. The rows are written before each of the two steps that
    read them twice, which would repeat the joins behind them.
    """
    columns = NARROW_COLUMNS if narrow else RANKED_COLUMNS
    if narrow:
        rows = materialize(rows.select("status", "line_key", "status_ts", "order_key", "sched", "qty", "_ol_ts"))
    latest = (joins.on_calendar(rows, F.to_date("_ol_ts"), inputs["time_dim"])
              .groupBy(F.col("order_key").alias("_m_order"), F.col("line_key").alias("_m_line"),
                       F.col("sched").alias("_m_sched"))
              .agg(F.max("status_ts").alias("_m_ts")))
    statuses = (inputs["status_dim"].filter(F.col("ptype") == P.PO_PROCESS_TYPE)
                .select(F.col("status").alias("_st"), "descr"))
    ranked = (rows.join(latest, (F.col("line_key") == F.col("_m_line")) & (F.col("status_ts") == F.col("_m_ts")))
                  .join(statuses, F.col("status") == F.col("_st"))
                  .select(*[F.col("_m_sched").alias(c) if c == "sched" else F.col(c) for c in columns]))
    top = top_ties(materialize(ranked) if narrow else ranked, ["line_key"], "status")
    return top.select(F.lit(1).alias("rco"), *columns)


def rank_lines(inputs, status_rows: DataFrame) -> DataFrame:
    """`rank_top_status` for all lines of a history: its rows are shuffled to their order and to their line, and ranked there.

    A window takes a line to one task. Rows of lines that are too large for it (found by a count of hashed line keys before)
    are ranked by `rank_top_status`, whose aggregates and joins share such a line among tasks.
    """
    status_rows = status_rows.filter(F.col("line_key").isNotNull())
    hot = hot_buckets(status_rows)
    if not hot:
        return _rank_in_windows(inputs, status_rows)
    is_hot = line_bucket().isin(hot)
    hot_rows = materialize(competing(materialize(status_rows.filter(is_hot))))
    return _rank_in_windows(inputs, status_rows.filter(~is_hot)).unionByName(
        rank_top_status(inputs, with_line_and_order(inputs, hot_rows)))


def line_bucket():
    return F.pmod(F.xxhash64("line_key"), F.lit(LINE_BUCKETS))


def hot_buckets(status_rows: DataFrame) -> list[int]:
    """The buckets of lines that hold more than `HOT_ROWS` status rows, the largest `HOT_BUCKETS` at most."""
    counts = status_rows.groupBy(line_bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return [r["bucket"] for r in counts.filter(F.col("n") > HOT_ROWS).orderBy(F.desc("n")).limit(HOT_BUCKETS).collect()]


def _rank_in_windows(inputs, status_rows: DataFrame) -> DataFrame:
    calendar = inputs["time_dim"].select(F.col("cal_date").alias("_cal_date")).distinct()
    lines = (inputs["oms_line"].join(calendar, F.to_date("order_ts") == F.col("_cal_date"), "left")
             .select(F.col("line_key").alias("_ol_line"), "item_id", F.col("_cal_date").isNotNull().alias("_dated")))
    orders = (inputs["oms_order"].filter(F.col("doc_type") == P.PO_DOC_TYPE)
              .select(F.col("order_key").alias("_ord_key"), "order_no", "doc_type"))
    # The line's join comes last: its shuffle serves the windows too.
    rows = (status_rows.join(orders, F.col("order_key") == F.col("_ord_key"))
                       .join(lines, F.col("line_key") == F.col("_ol_line")))
    # A line in the table twice gives each of its status rows twice: the line is dated if one of them is.
    schedule = (Window.partitionBy("line_key", "order_key", "sched")
                .orderBy(F.col("_dated").desc(), F.col("status_ts").desc_nulls_last()))
    is_last = (F.row_number().over(schedule) == 1) & F.col("_dated") & F.col("status_ts").isNotNull()
    ended = F.collect_list(F.when(F.col("_last"), F.struct("sched"))).over(Window.partitionBy("line_key", "status_ts"))
    statuses = (inputs["status_dim"].filter(F.col("ptype") == P.PO_PROCESS_TYPE)
                .select(F.col("status").alias("_st"), "descr"))
    ranked = (rows.withColumn("_last", is_last).withColumn("_ended", ended).filter(F.size("_ended") > 0)
                  .join(statuses, F.col("status") == F.col("_st"))
                  .withColumn("_top", F.max("status").over(Window.partitionBy("line_key"))))
    top = ranked.filter(F.col("status") == F.col("_top")).withColumn("_schedule", F.explode("_ended"))
    return top.select(F.lit(1).alias("rco"), *[F.col("_schedule.sched").alias(c) if c == "sched" else F.col(c) for c in RANKED_COLUMNS])


@dataclass
class Week:
    """The window's working set, shared by the exemption list and the candidates.

    `status_rows`: every release-status row of the lines that have a status
    row in the window. A line's top rows are among its own rows, so a line
    without a row in the window cannot have a top row there; keeping whole
    lines keeps maxima and ranks exact. `lines_slice` / `orders_slice`: the
    order lines of those status rows and every order they refer to (own,
    chained), cut from the histories once. `top`: the lines' top-status rows (None where the slices hold only
    the columns that the rule reads); `matched`: the status rows with their line and order, from which the top
    rows are ranked.
    """

    inputs: object
    start: dt.date
    end: dt.date
    status_rows: DataFrame
    top: DataFrame | None
    lines_slice: DataFrame | None = None
    orders_slice: DataFrame | None = None
    matched: DataFrame | None = None
    materialized: bool = True
    _lines: DataFrame | None = field(default=None, repr=False)

    def top_in_window(self) -> DataFrame:
        return self.top.filter(dates.ts_within(F.col("status_ts"), self.start, self.end))

    def lines(self) -> DataFrame:
        """In-window top rows with their line, PO order and chained order (built once)."""
        if self._lines is None:
            top = self.top if self.matched is None else rank_top_status(self.inputs, self.matched, narrow=True)
            rows = top.filter(dates.ts_within(F.col("status_ts"), self.start, self.end)).select(
                "line_key", F.to_date("status_ts").alias("STATUS_DATE"), "status", "descr",
                F.col("qty").alias("STATUS_QTY"))
            frame = _line_order_frame(self.inputs, rows, self.lines_slice, self.orders_slice)
            self._lines = materialize(frame) if self.materialized else frame
        return self._lines


def prepare_week(inputs, start: dt.date, end: dt.date, audit: Audit = NO_AUDIT, narrow: bool = False) -> Week:
    """Cut the status, line and order histories to the window's lines, then rank.

    Every history table is met through a semi join against a written key set
    (broadcast when small, so the history is scanned but not shuffled); the
    joins after that run on the written slices, whose real sizes the planner
    sees. `narrow`: the slices hold what the rule reads, so there are no top-status
    rows with all their columns.
    """
    status_rows, line_rows = inputs["rel_status"], inputs["oms_line"].select(*LINE_COLUMNS)
    if narrow:
        status_rows = status_rows.select(*STATUS_COLUMNS)
    keys = materialize(lines_active_in(inputs, start, end, audit))
    # `keys` is a distinct set already. The status and line slices are independent
    # jobs; submitting them together lets both history scans run at once.
    write = inheritable_thread_target(keys.sparkSession)(materialize)     # threads keep the job group
    with ThreadPoolExecutor(max_workers=2) as pool:
        active_job = pool.submit(copy_context().run, write, joins.exists_in(status_rows, keys, "line_key", written=True))
        lines_job = pool.submit(copy_context().run, write, joins.exists_in(line_rows, keys, "line_key", written=True))
        active, lines = active_job.result(), lines_job.result()
    order_keys = materialize(active.select(F.col("order_key").alias("k"))
                             .union(lines.select(F.col("order_key").alias("k")))
                             .union(lines.select(F.col("chain_order_key").alias("k"))).distinct())
    orders = materialize(joins.exists_in(inputs["oms_order"], order_keys, "order_key", "k", written=True))
    matched = with_line_and_order(inputs, active, "left", lines, orders).filter(
        F.col("_ol_line").isNotNull() & F.col("_ord_key").isNotNull())
    return Week(inputs, start, end, active, None if narrow else rank_top_status(inputs, matched), lines, orders, matched)


def top_status(inputs, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Top-status rows over the whole history, or over the window's lines."""
    if start is None:
        return rank_lines(inputs, inputs["rel_status"])
    return prepare_week(inputs, start, end).top


def top_status_of(inputs, state: DataFrame) -> DataFrame:
    """Top-status rows from the weekly state (`plans.top_state`): the same rows as from the whole history."""
    return rank_lines(inputs, state)


def top_status_report(inputs) -> DataFrame:
    """`top_status` over the whole history, with the source's column names."""
    return report(top_status(inputs))


def report(top: DataFrame) -> DataFrame:
    return top.select(*(F.col(src).alias(name) for name, src in TOP_STATUS_COLUMNS.items()))


def created_lines(status_rows: DataFrame) -> DataFrame:
    """Distinct (order, line, qty) of '1100' status rows (the MIN timestamp is unused)."""
    return (status_rows.filter(F.col("status") == P.STATUS_CREATED)
            .select("order_key", "line_key", "qty").distinct())


def latest_cancel(inputs, line_keys: DataFrame | None = None) -> DataFrame:
    """Cancel rows at each line's latest create time (ties kept), with the line's
    total qty. With `line_keys` (column `line_key`), only those lines are read;
    the result per line does not depend on other lines."""
    cl = inputs["cancel_line"].select("line_key", "create_ts", "cancel_qty", "code", "note")
    if line_keys is not None:
        cl = materialize(joins.exists_in(cl, line_keys, "line_key", written=True))    # read twice below
    latest = latest_with_total(cl, "line_key", "create_ts", "cancel_qty", "total_qty")
    return latest.select(F.col("line_key").alias("OMS_ORDER_LINE_KEY"),
                         F.col("code").alias("OMS_ORDER_CANCEL_RESN_CODE"),
                         F.col("note").alias("OMS_ORDER_CANCEL_RESN_NOTE"),
                         F.col("total_qty").alias("OMS_ORDER_CANCEL_QTY"))


def unit_cost(inputs, po_keys: DataFrame | None = None) -> DataFrame:
    """Distinct (PO, article, unit price) of PO lines delivered on a calendar day
    to a drop-ship store, with known article and vendor. One PO/article with two
    prices gives two rows. With `po_keys` (column `po_no`), only those POs are read."""
    po = inputs["po_line"].select("po_no", "article_no", "price", "deliv_date", "store_no", "vendor_id")
    if po_keys is not None:
        po = materialize(joins.exists_in(po, po_keys, "po_no", written=True))
    po = joins.on_calendar(po, F.col("deliv_date"), inputs["time_dim"])
    po = joins.exists_in(po, inputs["store"].filter(F.col("chan") == P.DROPSHIP_CHANNEL), "store_no")
    po = joins.exists_in(po, inputs["article"], "article_no")
    po = joins.exists_in(po, inputs["vendor"], "vendor_id")
    return po.select(F.col("po_no").alias("PO_NO"), F.col("article_no").alias("ARTICLE_NO"),
                     F.col("price").alias("PO_LINE_UNIT_PRICE")).distinct()


# ---------------------------------------------------------------------------
# The two staging results and the feed
# ---------------------------------------------------------------------------

def _line_order_frame(inputs, top_rows: DataFrame, lines: DataFrame | None = None,
                      orders: DataFrame | None = None) -> DataFrame:
    """Top rows joined to their line, their (calendar-dated) PO order and the
    chained customer order; the chained line must exist. `lines` / `orders`
    are slices of the line and order tables holding at least the keys met."""
    sliced = lines is not None
    lines = (lines if sliced else inputs["oms_line"]).select(
        F.col("line_key").alias("_l_key"), F.col("order_key").alias("_l_order"), "chain_order_key",
        "chain_line_key", "ship_node", F.col("item_id").alias("_l_item"), "unit_price", "orig_qty", "cat")
    orders = orders if orders is not None else inputs["oms_order"]
    po_orders = joins.on_calendar(orders.filter(F.col("doc_type") == P.PO_DOC_TYPE),
                                  F.to_date("order_ts"), inputs["time_dim"]).select(
        F.col("order_key").alias("_o_key"), F.col("order_no").alias("_o_no"),
        F.to_date("order_ts").alias("_o_date"))
    chained = orders.select(F.col("order_key").alias("_c_key"), F.col("order_no").alias("_c_no"))
    frame = joins.left_join(top_rows.join(lines, F.col("line_key") == F.col("_l_key"))
                            .join(po_orders, F.col("_l_order") == F.col("_o_key")),
                            chained, "chain_order_key", "_c_key")
    chain_lines = joins.exists_in(inputs["oms_line"].select("line_key"), lines, "line_key", "chain_line_key", written=sliced)
    frame = joins.exists_in(frame, chain_lines, "chain_line_key", "line_key")
    return frame.withColumns({
        "PO_ORDER_NO": F.when(F.col("_c_no").isNotNull(), F.col("_o_no")),
        "ORDER_NO": F.coalesce(F.col("_c_no"), F.col("_o_no")),
    })


def rule_710_exempt(inputs, start: dt.date, end: dt.date,
                    p: P.Rule710Params = P.Rule710Params(), week: Week | None = None) -> DataFrame:
    """Distinct (status date, PO, order, exemption flag) of in-window top-status
    lines; a line's PO is exempt when any note on the PO order matches.

    Existence-only inner joins (ship node, created row, chained line) are
    semi joins; the audit and cancel joins of the source feed no column of
    this result and are left out (rows only repeat, and the result is distinct).
    """
    week = week or prepare_week(inputs, start, end, narrow=True)
    frame = week.lines().select("line_key", "STATUS_DATE", "PO_ORDER_NO", "ORDER_NO", "ship_node", "_o_key")
    frame = joins.exists_in(frame, inputs["ship_node"], "ship_node")
    frame = joins.exists_in(frame, created_lines(week.status_rows), "line_key")
    # Notes of the frame's orders only: the history is filtered by a semi join. A note-heavy
    # order brings at most two rows, one per flag, to the join.
    flag = text.exemption_flag(F.col("code"), F.col("txt"), p.exempt_note_codes, p.exempt_note_texts)
    notes = (joins.exists_in(inputs["note"], week.lines(), "table_key", "_o_key", written=week.materialized)
             .select(F.col("table_key").alias("_n_key"), flag.alias("_flag")).distinct())
    frame = frame.join(notes, F.col("_o_key") == F.col("_n_key"), "left")
    unflagged = text.exemption_flag(F.lit(None).cast("string"), F.lit(None).cast("string"), p.exempt_note_codes, p.exempt_note_texts)
    return frame.select("STATUS_DATE", "PO_ORDER_NO", "ORDER_NO",
                        F.coalesce("_flag", unflagged).alias("DSV_EXCEPTION")).distinct()


def rule_710_cancels(inputs, start: dt.date, end: dt.date,
                     p: P.Rule710Params = P.Rule710Params(), week: Week | None = None,
                     audit: Audit = NO_AUDIT) -> DataFrame:
    """Cancelled in-window PO lines with demand, audit, cancel and cost columns,
    distinct over all 18 columns (the unit price takes part in the distinct)."""
    return distinct_candidates(candidate_rows(inputs, start, end, p, week, audit))


def distinct_candidates(rows: DataFrame) -> DataFrame:
    """The candidates of `candidate_rows`, whatever lines they come from."""
    distinct = rows.select(*CANCEL_COLUMNS[:-1], "PO_LINE_UNIT_PRICE").distinct()
    return distinct.select(*CANCEL_COLUMNS[:-1], _item_cost().alias("ITEM_COST"))


def _item_cost():
    return (F.col("PO_LINE_UNIT_PRICE") * F.col("STATUS_QTY")).cast(COST)


def candidate_rows(inputs, start: dt.date, end: dt.date, p: P.Rule710Params = P.Rule710Params(),
                   week: Week | None = None, audit: Audit = NO_AUDIT) -> DataFrame:
    """The candidates with the line each comes from (`line_key`) and its unit price; rows can repeat.

    The candidate lines are materialized first; the cancel and PO-line
    histories are then read only for the candidates' chained lines and POs.
    """
    week = week or prepare_week(inputs, start, end, narrow=True)
    # The category filter is on the line, so it commutes with the inner joins of `lines()`.
    cancelled = week.lines().filter(F.col("status") == P.STATUS_CANCELLED)
    kept = pred.not_in_dropping_null(F.col("cat"), p.excluded_categories)
    frame = audit.exclude(cancelled, kept, "category")
    nodes = (joins.exists_in(inputs["ship_node"], cancelled.filter(kept), "ship_node")
             .select(F.col("ship_node").alias("_sn"), "node_desc"))
    audits = (joins.exists_in(inputs["audit"].filter(F.col("code").isNotNull()), week.lines(), "order_key", "_o_key",
                              written=week.materialized)
              .select(F.col("order_key").alias("_a_key"), F.col("code").alias("_a_code"),
                      F.col("text").alias("_a_text")).distinct())
    created = (created_lines(week.status_rows)
               .select(F.col("line_key").alias("_r_line"), F.col("qty").alias("_r_qty")).distinct())
    slice_ = materialize(frame.join(nodes, F.col("ship_node") == F.col("_sn"))
                              .join(audits, F.col("_o_key") == F.col("_a_key"), "left")
                              .join(created, F.col("line_key") == F.col("_r_line")))
    cancels = (latest_cancel(inputs, slice_.select(F.col("chain_line_key").alias("line_key")))
               .drop("OMS_ORDER_CANCEL_QTY").distinct())
    frame = slice_.join(cancels, F.col("chain_line_key") == F.col("OMS_ORDER_LINE_KEY"), "left")
    demand_qty = F.coalesce(F.col("_r_qty"), F.col("orig_qty"))
    cand = frame.select(
        "line_key", F.col("_o_date").alias("ORDER_DATE"), "STATUS_DATE", "PO_ORDER_NO", "ORDER_NO",
        F.col("_l_item").alias("OMS_ITEM_ID"), F.col("unit_price").alias("OMS_ORDER_LINE_UNIT_PRICE"),
        "STATUS_QTY", demand_qty.alias("DEMAND_QTY"),
        (F.col("unit_price") * demand_qty).cast(COST).alias("DEMAND_SALES"),
        F.col("status").alias("OMS_ORDER_RELEASE_STATUS"), F.col("descr").alias("OMS_STATUS_DESC"),
        F.col("_a_code").alias("OMS_ORDER_AUDIT_RESN_CODE"), F.col("_a_text").alias("OMS_ORDER_AUDIT_RESN_TEXT"),
        "OMS_ORDER_CANCEL_RESN_CODE", "OMS_ORDER_CANCEL_RESN_NOTE",
        F.col("_sn").alias("OMS_SHIP_NODE_KEY"), F.col("node_desc").alias("OMS_SHIP_NODE_DESC"))
    costs = unit_cost(inputs, slice_.select(F.col("PO_ORDER_NO").alias("po_no")))
    # Rows without a PO can't match; they stay out of the join's shuffle.
    priced = cand.filter(F.col("PO_ORDER_NO").isNotNull()).join(
        costs, (F.col("PO_ORDER_NO") == F.col("PO_NO")) & (F.col("OMS_ITEM_ID") == F.col("ARTICLE_NO")), "left")
    cost = costs.schema["PO_LINE_UNIT_PRICE"].dataType
    return priced.select(*cand.columns, "PO_LINE_UNIT_PRICE").unionByName(
        cand.filter(F.col("PO_ORDER_NO").isNull()).withColumn("PO_LINE_UNIT_PRICE", F.lit(None).cast(cost)))


CHARGED = "charged"


def rule_710_lineage(inputs, start: dt.date, end: dt.date, p: P.Rule710Params = P.Rule710Params(),
                     week: Week | None = None, rows: DataFrame | None = None, exempt: DataFrame | None = None) -> DataFrame:
    """Which cancelled lines of the window each charge comes from, and why the others are not charged.

    (LINE_KEY, PO_NUMBER, AUDIT_COMMENTS, CHARGE, REASON, SAME_AS): a row per line and candidate. Summed per PO and comment,
    CHARGE gives the feed exactly. Lines that give the same candidate are charged once: the one with the least key carries
    the charge, the others name it in SAME_AS. A line that never becomes a candidate has one row with the reason. `rows`,
    `exempt`: `candidate_rows` and `rule_710_exempt`, where they are written already.
    """
    week = week or prepare_week(inputs, start, end, narrow=True)
    rows = materialize(rows if rows is not None else candidate_rows(inputs, start, end, p, week))
    exempt = exempt if exempt is not None else rule_710_exempt(inputs, start, end, p, week)
    # Lines of one candidate are found by a digest of its columns, so that they can be folded before they meet.
    candidate = F.sha2(F.to_json(F.struct(*CANCEL_COLUMNS[:-1], "PO_LINE_UNIT_PRICE"), {"ignoreNullFields": "false"}), 256)
    rows = rows.withColumn("_candidate", candidate).distinct()
    owners = rows.groupBy("_candidate").agg(F.min("line_key").alias("_owner"))
    exempt_pos = (exempt.filter((F.col("DSV_EXCEPTION") == F.lit("Y")) & F.col("PO_ORDER_NO").isNotNull())
                  .select(F.col("PO_ORDER_NO").alias("_exempt")).distinct())
    judged = joins.left_join(rows.join(owners, "_candidate"), exempt_pos, "PO_ORDER_NO", "_exempt")
    code, note = F.col("OMS_ORDER_CANCEL_RESN_CODE"), F.col("OMS_ORDER_CANCEL_RESN_NOTE")
    reason = (F.when(code.isNull() | (code == P.REMORSE_CODE), "remorse or no cancel code")
              .when(F.col("_exempt").isNotNull(), "exempt PO")
              .when(F.col("OMS_ORDER_AUDIT_RESN_CODE").isin(list(p.audit_exclude_reasons)), "audit reason")
              .when(note.isin(list(p.cancel_note_exclude_reasons)), "cancel note")
              .when(F.col("line_key") != F.col("_owner"), "same candidate as another line").otherwise(CHARGED))
    charge = money.rate(money.zero_if_missing(_item_cost()), P.CANCEL_RATE)
    judged = judged.withColumn("REASON", reason).select(
        F.col("line_key").alias("LINE_KEY"), F.col("PO_ORDER_NO").alias("PO_NUMBER"),
        text.comment_710(F.col("ORDER_DATE"), F.col("STATUS_DATE")).alias("AUDIT_COMMENTS"),
        F.when(F.col("REASON") == CHARGED, charge).alias("CHARGE"), "REASON",
        F.when(F.col("REASON") == "same candidate as another line", F.col("_owner")).alias("SAME_AS"))
    cancelled = week.lines().filter(F.col("status") == P.STATUS_CANCELLED)
    others = joins.anti_keeping_null(cancelled, rows.select("line_key"), "line_key").withColumn(
        "REASON", F.when(pred.not_in_dropping_null(F.col("cat"), p.excluded_categories), "no ship node or created row").otherwise("category"))
    left_out = others.select(
        F.col("line_key").alias("LINE_KEY"), F.col("PO_ORDER_NO").alias("PO_NUMBER"),
        text.comment_710(F.col("_o_date"), F.col("STATUS_DATE")).alias("AUDIT_COMMENTS"),
        F.lit(None).cast(judged.schema["CHARGE"].dataType).alias("CHARGE"), "REASON", F.lit(None).cast("string").alias("SAME_AS")).distinct()
    return judged.unionByName(left_out)


def rule_710(cancels: DataFrame, exempt: DataFrame, as_of: dt.date | None,
             p: P.Rule710Params = P.Rule710Params(), audit: Audit = NO_AUDIT) -> DataFrame:
    """Charge 3 % of item cost per PO and comment, after the exclusions."""
    exempt_pos = exempt.filter(F.col("DSV_EXCEPTION") == F.lit("Y")).select("PO_ORDER_NO")
    rows = audit.exclude(cancels, pred.differs_dropping_null(F.col("OMS_ORDER_CANCEL_RESN_CODE"), P.REMORSE_CODE),
                         "remorse or no cancel code")
    rows = audit.without(rows, lambda r: joins.anti_keeping_null(r, exempt_pos, "PO_ORDER_NO"), "exempt PO")
    rows = audit.exclude(rows, pred.not_in_keeping_null(F.col("OMS_ORDER_AUDIT_RESN_CODE"), p.audit_exclude_reasons), "audit reason")
    rows = audit.exclude(rows, pred.not_in_keeping_null(F.col("OMS_ORDER_CANCEL_RESN_NOTE"), p.cancel_note_exclude_reasons),
                         "cancel note")
    base = rows.select(
        F.col("PO_ORDER_NO").alias("PO_NUMBER"),
        text.comment_710(F.col("ORDER_DATE"), F.col("STATUS_DATE")).alias("AUDIT_COMMENTS"),
        money.rate(money.zero_if_missing(F.col("ITEM_COST")), P.CANCEL_RATE).alias("_charge"))
    summed = base.groupBy("PO_NUMBER", "AUDIT_COMMENTS").agg(
        money.zero_if_missing(F.sum("_charge")).alias("_amount"))
    feed = summed.select(
        F.lit(P.SITE).alias("SITE"),
        dates.audit_stamp(as_of).alias("AUDIT_TIMESTAMP"),
        "PO_NUMBER",
        F.lit(P.RULE_710).alias("RULE_NUMBER"),
        F.lit(P.VIOLATE).alias("VIOLATE_FLAG"),
        "AUDIT_COMMENTS",
        F.lit(P.ANCHOR).alias("ANCHOR_CONSTANT"),
        money.to_feed_amount(F.col("_amount")).alias("CHARGEBACK_AMOUNT"),
    )
    return schemas.assert_schema(feed, schemas.feed_schema(P.FEED_710_COLUMNS))


def run_rule_710(inputs, start: dt.date, end: dt.date, as_of: dt.date | None,
                 p: P.Rule710Params = P.Rule710Params(), audit: Audit = NO_AUDIT) -> DataFrame:
    """Both staging results over one shared working set, then the feed."""
    week = prepare_week(inputs, start, end, audit, narrow=True)
    return rule_710(rule_710_cancels(inputs, start, end, p, week, audit),
                    rule_710_exempt(inputs, start, end, p, week), as_of, p, audit)
