"""Logical sources and the roles of their columns.

A source is known by its headers, never by its file name. Each column that the
flow uses has a role; the registry says which header texts name a role in
which source, and ``view`` gives a table's columns their role names. What
comes after discovery speaks of roles only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import find_column
from .discovery import Resolution, SourceDefinition, discover, exclude_generated, file_header_rows, header_table, list_files, raw_head_rows, resolve
from .readers import read_csv_table


@dataclass(frozen=True)
class ColumnRole:
    """A role and the header texts that name it; the first one is the header that discovery asks for."""

    role: str
    headers: tuple[str, ...]
    required: bool = False


@dataclass(frozen=True)
class LogicalSource:
    name: str
    display_name: str
    columns: tuple[ColumnRole, ...]
    preferred_sheets: tuple[str, ...] = ("Sheet1",)
    filename_keywords: tuple[str, ...] = ()
    mandatory: bool = True

    def definition(self) -> SourceDefinition:
        """What discovery and validation ask of the source."""
        return SourceDefinition(
            self.name, tuple(c.headers[0] for c in self.columns if c.required), tuple(c.headers[0] for c in self.columns if not c.required),
            self.preferred_sheets, self.filename_keywords, self.mandatory, self.display_name)

    def header(self, role: str) -> str:
        return next(c.headers[0] for c in self.columns if c.role == role)

    def view(self, df: DataFrame) -> DataFrame:
        """The table with its columns under their role names. Names are matched trimmed and in any case (C9), the
        headers of a role in order; columns without a role keep their names, and a role that the table lacks is absent."""
        named: dict[str, str] = {}
        for c in self.columns:
            column = find_column(df, c.headers)
            if column is not None:
                named.setdefault(column, c.role)
        taken = set(named.values())
        return df.select(*[F.col(f"`{c}`").alias(named.get(c, c)) for c in df.columns if c in named or c not in taken])


def _source(name: str, display: str, required: Sequence[tuple], optional: Sequence[tuple] = (), **kw) -> LogicalSource:
    roles = [ColumnRole(r, tuple(h), True) for r, *h in required] + [ColumnRole(r, tuple(h)) for r, *h in optional]
    return LogicalSource(name, display, tuple(roles), **kw)


# The logical sources, their headers and the roles that these name.
SOURCES: tuple[LogicalSource, ...] = (
    _source(
        "orderbook", "Orderbook",
        (("order_number", "Sales Order No."), ("ndc", "NDC Code"), ("customer", "Sold-to party Name"), ("pack_size", "PackSize(MOQ)")),
        (
            ("item_number", "Item No."), ("material_code", "Matl.Code", "Matl.\nCode", "HANA Material"), ("material_description", "Material Description"),
            ("total_stock", "Total Stock In-hand", "Total Stock \nIn-hand"), ("quantity", "Sales Order Qty"), ("quantity_mtd", "Sales Qty MTD"),
            ("forecast", "Forecast Qty"), ("sold_to_party", "Sold-to party"), ("order_type", "S.O. Type"), ("unit_price", "Unit Price"),
            ("sales_value", "Sales Value (FC)", "Sales Value FC"), ("reference_price", "WAC/BG price in EDI"), ("po_number", "PO number"),
            ("po_date", "PO date"), ("ship_to_party", "Ship-to party"), ("ship_to_name", "Ship-to party Name"), ("street", "Street"),
            ("city", "City"), ("region", "Region"), ("postal_code", "Postal Code"), ("country", "Country"), ("reject_code", "Reas. Rej."),
            ("reject_reason", "Reason for Rejection"), ("material_block", "Material Blk"), ("floor_block", "Floor limit Blk"),
            ("moq_block", "Multiple of MOQ Blk"), ("price_block", "Expected Price Blk"), ("dea_number", "DEA Number (Customer Master)"),
            ("delivery_date", "Req. Delivery Date"), ("som_indicator", "SOM Indc."), ("action", "Action"),
        ),
        preferred_sheets=("UOB", "Sheet1"),
    ),
    _source(
        "moq", "Material Description / MOQ Master",
        (("material_code", "HANA Material"), ("ndc", "NDC code"), ("material_description", "Material Description")),
        (("moq", "MOQ "),),
    ),
    _source(
        "inventory", "Daily Inventory",
        (("ndc", "NDC"), ("actual_quantity", "Actual Quantity"), ("inventory", "Inventory")),
        (("sku", "SKU"), ("description", "Description"), ("allocated_quantity", "Allocated Quantity"), ("hold_codes", "Hold Codes")),
    ),
    _source(
        "open_order_summary", "Open Order Summary",
        (("sku", "SKU"), ("total", " Total "), ("status", "Pickticket Status")),
        (("sku_description", "IM_SKU_DESC"), ("customer", "PH_SOLDTO_NAME"), ("order_number", "SO#"), ("customer_group", "Customer Group"), ("lookup", "x")),
    ),
    _source("buying_groups", "Buying Groups", (("customer", "Customer"), ("buying_group", "Customer buying group"))),
    _source(
        "awards", "Awards", (("ndc", "NDC"), ("sold_to", "Customer")),
        (("award_type", "Award Type"), ("description", "Description"), ("sold_to_party", "Sold to party"), ("lookup", "Lookup")),
    ),
    _source(
        "critical_inventory_tracker", "Critical Inventory Tracker", (("ndc", "NDC"), ("comments", "Comments")),
        (("customer_eta", "Customer ETA"), ("description", "Description"), ("tracker_date", "Tracker Date", "Date", "Updated")),
    ),
    _source(
        "sales_summary", "Sales Summary", (("order_number", "Sales Order No."), ("ndc", "NDC Code"), ("lookup", "Lookup")),
        (
            ("summary_pack_size", "Pack Size (MOQ)"), ("quantity", "Sales Order Qty"), ("quantity_mtd", "Sales Qty MTD"),
            ("forecast", "Forecast Qty"), ("material_description", "Material Description"), ("customer", "Sold-to party Name"),
        ),
        mandatory=False,
    ),
    _source(
        "sales_trend", "Sales Trend", (("material_description", "Material Description"), ("customer_group", "Cust Group")),
        (("ndc", "NDC Code"), ("customer", "Sold-to party Name"), ("lookup", "Lookup", "x"), ("contract_id", " Cont ID ")),
    ),
    _source(
        "upload_sheet", "Upload Sheet",
        (("ndc", "NDC Code", "NDC", "ndc_code"), ("reason", "Reason Code", "reason_code"), ("action", "Action"), ("quantity", "Sales Order Qty", "sales_order_qty")),
        (("order_number", "Sales Order No."), ("material_description", "Material Description"), ("customer", "Sold-to party Name")),
        filename_keywords=("upload",), mandatory=False,
    ),
)

def load_sources(spark: SparkSession, paths: str | Sequence[str], sources: Sequence[LogicalSource] = SOURCES, order: str = "_row") -> tuple[dict[str, DataFrame], Resolution]:
    """Discovery to role-named tables (A1, A2, A8, A13): the CSV files under ``paths``, our own outputs left out,
    are matched to the sources by their headers; each table has its rows' order in column ``order``. A mandatory
    source that is missing or ambiguous raises; optional ones are absent."""
    files = exclude_generated(list_files(spark, paths))
    positions = file_header_rows(spark, files)
    headers = header_table(raw_head_rows(spark, files), positions)
    definitions = [s.definition() for s in sources]
    found = resolve(discover(headers, definitions), definitions)
    below = {(r["workbook"], r["sheet"]): r["header_idx"] for r in positions.collect()}  # one row per file
    tables = {}
    for s in sources:
        where = found.resolved.get(s.name)
        if where is not None:
            tables[s.name] = s.view(read_csv_table(spark, where[0], below[where], order=order))
    return tables, found
