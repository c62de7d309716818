"""Rule constants, exclusion lists and comment texts.

Everything under the "fixed values" banner must equal the source rules
verbatim (spelling mistakes and double spaces included): the filters
match these strings exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# ---------------------------------------------------------------------------
# Fixed values (must equal the source rules exactly)
# ---------------------------------------------------------------------------

SITE = 5509
ANCHOR = "x"
VIOLATE = "Y"

RULE_702 = "DMC702"
RULE_706 = "DMC706"
RULE_710 = "DMC710"

# Rule 702: carrier service codes ordered as ground.
GROUND_SERVICE_CODES = ("Ground", "FedEx Ground")

# Rule 702: FedEx invoice service types that count as ground.
FEDEX_GROUND_TYPES = (
    "Fedex Ground",
    "FedEx Ground",
    "FedEx Ground Economy",
    "FedEx Home Delivery (Ground)",
    "FedEx Intl. Economy Export",
    "FedEx Intl. Economy Freight",
    "FedEx Intl. Economy Import",
)

# Rule 702: UPS invoice zones that count as ground (strings, not numbers).
UPS_GROUND_ZONES = (
    "2", "3", "4", "5", "6", "7", "8",
    "002", "003", "004", "005", "006", "007", "008",
    "44", "45", "46", "044", "045", "046",
)

# Rule 702: ship nodes whose shipments are never charged.
EXCLUDED_SHIP_NODES = ("800554", "800715")

# Rule 702: amount added to the freight before the sign is dropped.
FREIGHT_OFFSET = Decimal("20")

# Rule 706: share of the total charge that is charged back.
BOL_RATE = Decimal("0.65")

# Rule 710: share of the item cost that is charged back.
CANCEL_RATE = Decimal("0.03")

# Rule 710: document type of purchase orders, status codes, process type.
PO_DOC_TYPE = "0005"
STATUS_CREATED = "1100"
STATUS_CANCELLED = "9000"
PO_PROCESS_TYPE = "PO_FULFILLMENT"
DROPSHIP_CHANNEL = 30
REMORSE_CODE = "REMORSE"

# Rule 710: item categories never charged.
EXCLUDED_CATEGORIES = ("983", "981", "782")

# Rule 710: note reason codes that exempt a purchase order.
EXEMPT_NOTE_CODES = (
    "Customer Requests Cancellation witin SLA",
    "Customer Requests Cancellation within SLA",
    "TSC Requests Cancellation Exempt",
    "TSC Requests Cancellation  Exempt",
    "Vendor Can't Ship to Address",
    "PO Not Received",
    "PO has not been received",
    "Weather Delay",
    "Item is cancelled - Cannot ship to State selected",
)

# Rule 710: note text fragments that exempt a purchase order (substring match).
EXEMPT_NOTE_TEXTS = (
    "Vendor cannot ship to address - customer input needed",
    "Carrier pick up requested, but not picked up yet",
    "Closed for Federal Holiday",
    "Vendor closed for Inventory Audit",
    "PO received with 0$ cost",
)

# Rule 710: order audit reason codes that remove a candidate line.
AUDIT_EXCLUDE_REASONS = (
    "Customer Requests Cancellation witin SLA",
    "Customer Requests Cancellation within SLA",
    "Customer Requests Cancellation in SLA",
    "Customer Request Cancellation within SLA",
    "TSC Requests Cancellation Exempt",
    "TSC Requests Cancellation  Exempt",
    "Vendor Can't Ship to Address",
    "PO Not Received",
    "Weather Delay",
)

# Rule 710: cancel notes that remove a candidate line (exact match).
CANCEL_NOTE_EXCLUDE_REASONS = (
    "Closed for Federal Holiday",
    "Vendor closed for Inventory Audit",
    "PO received with 0$ cost",
)

# Comment texts.
COMMENT_702_PREFIX = "DMC702 Tracking: "
COMMENT_702_SUFFIX = (
    " Vendor expedited shipment without prior authorization from TSC's Dropship team."
    " Please ship using the requested method on the PO"
)
COMMENT_706_PREFIX = "PRO: "
COMMENT_706_SUFFIX = (
    " Vendor must include the words Tractor Supply Company in front of or in place of"
    " their company name on the Ship From section of the BOL; failure causes TSC's ship"
    " rate discount with the carrier to be removed. Please ensure that all BOLs contain"
    " this verbiage going forward."
)
COMMENT_710_ORDER = "Order Date: "
COMMENT_710_CANCEL = "Cancellation Date: "

# Feed column order per rule.
FEED_702_COLUMNS = (
    "AUDIT_TIMESTAMP", "PO_NUMBER", "RULE_NUMBER", "VIOLATE_FLAG",
    "AUDIT_COMMENTS", "CHARGEBACK_AMOUNT", "ANCHOR_CONSTANT", "SITE",
)
FEED_706_COLUMNS = (
    "SITE", "AUDIT_TIMESTAMP", "PO_NUMBER", "RULE_NUMBER", "VIOLATE_FLAG",
    "AUDIT_COMMENTS", "CHARGEBACK_AMOUNT", "ANCHOR_CONST",
)
FEED_710_COLUMNS = (
    "SITE", "AUDIT_TIMESTAMP", "PO_NUMBER", "RULE_NUMBER", "VIOLATE_FLAG",
    "AUDIT_COMMENTS", "ANCHOR_CONSTANT", "CHARGEBACK_AMOUNT",
)
# ---------------------------------------------------------------------------
# Tunable parameters (lists a deployment may replace)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule702Params:
    ground_service_codes: tuple[str, ...] = GROUND_SERVICE_CODES
    fedex_ground_types: tuple[str, ...] = FEDEX_GROUND_TYPES
    ups_ground_zones: tuple[str, ...] = UPS_GROUND_ZONES
    excluded_ship_nodes: tuple[str, ...] = EXCLUDED_SHIP_NODES


@dataclass(frozen=True)
class Rule710Params:
    excluded_categories: tuple[str, ...] = EXCLUDED_CATEGORIES
    exempt_note_codes: tuple[str, ...] = EXEMPT_NOTE_CODES
    exempt_note_texts: tuple[str, ...] = EXEMPT_NOTE_TEXTS
    audit_exclude_reasons: tuple[str, ...] = AUDIT_EXCLUDE_REASONS
    cancel_note_exclude_reasons: tuple[str, ...] = CANCEL_NOTE_EXCLUDE_REASONS


@dataclass(frozen=True)
class TestDataParams:
    """Parameters used against the TPC-H-derived test tables.

    The production lists name warehouses, categories and reasons that do not
    occur in the test tables; these substitutes make every branch fire.
    """

    rule_702: Rule702Params = field(default_factory=lambda: Rule702Params(
        fedex_ground_types=("FedEx Ground",),
        ups_ground_zones=("2", "3", "4", "5", "6", "7", "8"),
        excluded_ship_nodes=("7", "11"),
    ))
    rule_710: Rule710Params = field(default_factory=lambda: Rule710Params(
        excluded_categories=("1", "2", "3"),
        exempt_note_codes=("PO Not Received",),
        exempt_note_texts=("Closed for Federal Holiday",),
        audit_exclude_reasons=("Weather Delay",),
        cancel_note_exclude_reasons=("Closed for Federal Holiday",),
    ))
