"""The reference's jobs as DataFrame builders.

Entities: customers, orders, order lines and contacts, from any input that a
``Columns`` describes (``TABLE_COLUMNS``: the driver's tables; ``LAYOUT_COLUMNS``:
the delimited layouts). Document field names follow the reference's documents
(typos corrected: ``orderAmount``, ``orderLines``, ``amount``).

Every builder returns a DataFrame; nothing is collected, and only
``three_level_documents`` and the job write (to the shared folder) before. Children are
aggregated before they are joined to their parent (see ``operators.nest``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroll.functions.scalars import (
    REFERENCE_BUCKET_THRESHOLDS,
    REFERENCE_CUTOFF,
    java_date_text,
)
from docroll.operators.joins import ORPHAN_POLICIES, orphans
from docroll.operators.nest import PAGE_SIZE, Child, group_documents, nest
from docroll.operators.rollups import customer_rollup, order_rollup
from docroll.plans.columns import TABLE_COLUMNS, Columns
from docroll.session import stage

DATES = ("createDate", "updateDate", "shipDate")


# --- entity projections --------------------------------------------------

def _fields(df: DataFrame, found: Mapping[str, str], dates_as_text: bool = False) -> list[Column]:
    """The entity's columns under their field names."""
    out = []
    for field, column in found.items():
        value = java_date_text(column, df.schema[column].dataType) if dates_as_text and field in DATES else F.col(column)
        out.append(value.alias(field))
    return out


def line_items(lines: DataFrame, columns: Columns = TABLE_COLUMNS) -> DataFrame:
    """Order lines with document field names. The ids are not always unique in
    the data, so lists are ordered by the whole item."""
    return lines.select(*_fields(lines, columns.found("line", lines, ("id", "orderId", "amount"))))


def contact_items(contacts: DataFrame, columns: Columns = TABLE_COLUMNS) -> DataFrame:
    """Contacts with document field names (``type`` is the reference's ``typo``)."""
    return contacts.select(*_fields(contacts, columns.found("contact", contacts, ("id", "customerId"))))


def _contacts(contacts: DataFrame, columns: Columns, count_as: str | None = None) -> Child:
    items = contact_items(contacts, columns)
    return Child(items, on="customerId", into="contacts", fields=items.columns, count_as=count_as)


# --- order documents with their lines (two-way cogroup) ------------------

def order_documents(
    orders: DataFrame,
    lines: DataFrame,
    page_size: int | None = PAGE_SIZE,
    columns: Columns = TABLE_COLUMNS,
    one_per_key: bool = True,
    held_as: str | None = None,
) -> DataFrame:
    """One document per order (page): header, ``lineCount``, ``orderAmount`` and the
    sorted ``orderLines``; an order without lines has an empty list and 0.
    Integer amounts sum to integers."""
    parent = orders.select(*_fields(orders, columns.found("order", orders, ("id", "customerId")), dates_as_text=True))
    items = line_items(lines, columns)
    whole = isinstance(items.schema["amount"].dataType, T.IntegralType)
    child = Child(
        items,
        on="orderId",
        into="orderLines",
        fields=items.columns,
        count_as="lineCount",
        sums={"orderAmount": "amount"},
        fill={"orderAmount": 0 if whole else 0.0},
        held_as=held_as,
    )
    return nest(parent, "id", [child], page_size=page_size, one_per_key=one_per_key)


# --- customer documents with orders and contacts (three-way cogroup) ----

def customer_documents(
    customers: DataFrame,
    orders: DataFrame,
    contacts: DataFrame,
    page_size: int | None = PAGE_SIZE,
    columns: Columns = TABLE_COLUMNS,
    one_per_key: bool = True,
) -> DataFrame:
    """Customer header with two child lists (the three-way cogroup)."""
    parent = customers.select(*_fields(customers, columns.found("customer", customers, ("id",))))
    found = columns.found("order", orders, ("id", "customerId"))
    found.pop("orderType", None)  # not in this document
    items = orders.select(*_fields(orders, found, dates_as_text=True))
    order_child = Child(items, on="customerId", into="orders", fields=items.columns, count_as="orderCount")
    return nest(parent, "id", [_contacts(contacts, columns, "contactCount"), order_child], page_size=page_size, one_per_key=one_per_key)


# --- three levels: customer -> orders -> lines, plus contacts ------------

def three_level_documents(
    customers: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    contacts: DataFrame,
    page_size: int | None = PAGE_SIZE,
    columns: Columns = TABLE_COLUMNS,
    one_per_key: bool = True,
) -> DataFrame:
    """customer -> orders -> lines, plus contacts: lines are nested into
    orders first, then the order documents into customers (bottom-up). An order
    (page) weighs the lines it holds and one more, so a customer's pages are
    bounded by what they hold at both levels. The paged order documents are
    written once to the shared folder: paging reads them for weights, then for
    their places, and only the second reads the lists."""
    orders_nested = order_documents(orders, lines, page_size, columns, one_per_key, held_as="linesHere")
    if page_size is not None:
        orders_nested = stage(orders_nested, "order-documents")
    found = columns.found("customer", customers, ("id", "name"))
    parent = customers.select(F.col(found["id"]).alias("customerId"), F.col(found["name"]).alias("name"))
    order_child = Child(
        orders_nested,
        on="customerId",
        into="orders",
        fields=("id", "part", "customerId", "orderDescription", "orderAmount", "lineCount", "orderLines"),
        weight=F.col("linesHere") + 1,
    )
    return nest(parent, "customerId", [_contacts(contacts, columns), order_child], page_size=page_size, one_per_key=one_per_key)


# --- rollups and their documents ----------------------------------------

def rolled_orders(orders: DataFrame, lines: DataFrame, columns: Columns = TABLE_COLUMNS) -> DataFrame:
    """Order rollup (orders with at least one line), under the input's names."""
    order = columns.found("order", orders, ("id", "customerId", "createDate"))
    line = columns.found("line", lines, ("orderId", "amount"))
    kept = [order[f] for f in ("customerId", "orderType", "orderDescription", "createDate") if f in order]
    return order_rollup(lines, orders, line_order_key=line["orderId"], order_key=order["id"], amount=line["amount"], order_cols=kept)


def rolled_customers(
    orders_rolled: DataFrame,
    customers: DataFrame,
    cutoff: str | _dt.date = REFERENCE_CUTOFF,
    thresholds: Sequence[float] = REFERENCE_BUCKET_THRESHOLDS,
    columns: Columns = TABLE_COLUMNS,
) -> DataFrame:
    """Customer rollup over the rolled-up orders."""
    order = columns.found("order", orders_rolled, ("customerId", "createDate"))
    customer = columns.found("customer", customers, ("id", "name"))
    return customer_rollup(
        orders_rolled,
        customers,
        customer_key=customer["id"],
        order_customer_key=order["customerId"],
        date_col=order["createDate"],
        customer_cols=(customer["name"],),
        cutoff=cutoff,
        thresholds=thresholds,
    )


def rollup_documents(
    customers_rolled: DataFrame,
    orders_rolled: DataFrame,
    contacts: DataFrame,
    page_size: int | None = PAGE_SIZE,
    columns: Columns = TABLE_COLUMNS,
) -> DataFrame:
    """The README job's customer documents: rollup fields, contacts with
    type, orders with their totals and dates (no ``numberOfOrder``, as in the
    reference's nested document)."""
    customer = columns.found("customer", customers_rolled, ("id", "name"))
    order = columns.found("order", orders_rolled, ("id", "customerId"))
    parent = customers_rolled.select(
        F.col(customer["id"]).alias("customerId"), F.col(customer["name"]).alias("name"), "total", "max", "avg", F.col("bucket").alias("range")
    )
    names = {"id": "orderId", "customerId": "customerId", "orderType": "orderType", "orderDescription": "orderDescription"}
    fields = [F.col(order[f]).alias(n) for f, n in names.items() if f in order] + [F.col("total").alias("orderTotal")]
    if "createDate" in order:
        fields.append(F.col(order["createDate"]).alias("orderDate"))
    items = orders_rolled.select(*fields)
    order_child = Child(items, on="customerId", into="orders", fields=items.columns)
    # the rollups have one row per key already
    return nest(parent, "customerId", [_contacts(contacts, columns), order_child], page_size=page_size)


def flat_customer_documents(customers_rolled: DataFrame, columns: Columns = TABLE_COLUMNS) -> DataFrame:
    """The flat typed document sent to the search index."""
    customer = columns.found("customer", customers_rolled, ("id", "name"))
    return customers_rolled.select(
        F.col(customer["id"]).alias("id"),
        F.col(customer["name"]).alias("name"),
        "total",
        "max",
        "avg",
        F.col("n_orders").alias("numberOfOrder"),
        F.col("bucket").alias("range"),
    )


# --- customers nested from a SQL join -----------------------------------

def names_with_descriptions(order_groups: DataFrame, page_size: int | None = PAGE_SIZE) -> DataFrame:
    """One document per customer name with the list of order descriptions.

    ``order_groups`` is the right-join/count result (one row per customer
    and description). Namesakes share a document; a null name (orders
    without a customer) is its own document. The groups are the documents,
    so lists and the siren come from one aggregation.
    """
    child = Child(
        order_groups.select(
            "c_name", "c_nationkey", F.col("o_orderpriority").alias("desc"), F.col("c_custkey").alias("customerId")
        ),
        on="c_name",
        into="orderList",
        fields=("desc", "customerId"),
        aggs={"customerSiren": F.min("c_nationkey")},
    )
    docs = group_documents(child, page_size=page_size)
    return docs.withColumnRenamed("c_name", "customerName")


# --- flat summaries of nested documents (used by checks) -----------------

def summed_over_parts(docs: DataFrame, key: str, sums: dict, keep: Sequence[str] = ()) -> DataFrame:
    """Whole-parent sums of per-part document values (exact, partial-aggregated)."""
    aggs = [F.sum(expr).alias(name) for name, expr in sums.items()]
    aggs += [F.min(c).alias(c) for c in keep]  # same on every part
    return docs.groupBy(key).agg(*aggs)


# --- rows that the documents leave out -----------------------------------

def missing_rows(customers: DataFrame, orders: DataFrame, lines: DataFrame, contacts: DataFrame, columns: Columns = TABLE_COLUMNS) -> DataFrame:
    """One row (kind, id) per row that no document holds for want of a partner."""
    c, o, l, e = (columns.found(n, df) for n, df in (("customer", customers), ("order", orders), ("line", lines), ("contact", contacts)))
    line_id = l.get("id", l["orderId"])
    checks = [
        ("line_without_order", lines, orders, l["orderId"], o["id"], line_id),
        ("order_without_customer", orders, customers, o["customerId"], c["id"], o["id"]),
        ("contact_without_customer", contacts, customers, e["customerId"], c["id"], e["id"]),
        ("order_without_lines", orders, lines, o["id"], l["orderId"], o["id"]),
    ]
    out = None
    for kind, child, parent, child_on, parent_on, key in checks:
        part = orphans(child, parent, child_on, parent_on).select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


# --- the README job end to end ----------------------------------------------

def run_rollup_job(
    spark,
    customers: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    contacts: DataFrame,
    target: str,
    cutoff: str | _dt.date = REFERENCE_CUTOFF,
    thresholds: Sequence[float] = REFERENCE_BUCKET_THRESHOLDS,
    fmt: str = "json",
    options: dict | None = None,
    mode: str = "overwrite",
    legacy_names: bool = False,
    missing: str = "report",
    stage_dir: str | None = None,
    page_size: int | None = PAGE_SIZE,
    cache: bool = False,
    keep_stage: bool = False,
    columns: Columns = TABLE_COLUMNS,
) -> dict[str, str]:
    """Order rollup -> customer rollup -> flat customer documents (search
    index) and nested customer documents (document store).

    Each rollup is used twice, so each is computed once: both are written as
    parquet tables in a fresh folder below ``stage_dir`` (default: the shared
    ``spark.checkpoint.dir``) and read back. This cuts the lineage (a lost
    executor re-reads files instead of recomputing the line aggregation)
    without holding anything in executor memory. With ``cache=True`` the two
    rollups are persisted (memory and disk) instead and unpersisted after the
    writes; a lost executor then recomputes its cached blocks from the lineage.

    ``mode`` and ``options`` go to both writers, ``legacy_names`` writes the
    original field spellings. ``missing``: rows that no document holds for want
    of a partner are written beside the documents (``report``), left out
    (``drop``), or stop the job before it writes (``fail``). The stage folder,
    and nothing else, is deleted in the end (``keep_stage``: not). Returns the
    written paths.
    """
    from docroll.session import remove_path, scratch_path
    from docroll.sinks.documents import rename_fields, write_docs

    if missing not in ORPHAN_POLICIES:
        raise ValueError(f"missing must be one of {ORPHAN_POLICIES}")
    out = {"customers_flat": f"{target}/customers_flat", "customers": f"{target}/customers"}

    def write(df: DataFrame, path: str) -> None:
        write_docs(rename_fields(df) if legacy_names else df, path, fmt=fmt, mode=mode, options=options)

    left_out = missing_rows(customers, orders, lines, contacts, columns)
    if missing == "fail" and not left_out.isEmpty():
        raise ValueError("rows without a partner; missing='report' writes them")

    stage = scratch_path(spark, "rollup-stage") if stage_dir is None else f"{stage_dir.rstrip('/')}/rollup-{_dt.datetime.now():%Y%m%d%H%M%S%f}"
    cached: list[DataFrame] = []

    def once(df: DataFrame, name: str) -> DataFrame:
        if cache:
            cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return cached[-1]
        df.write.parquet(f"{stage}/{name}")
        return spark.read.schema(df.schema).parquet(f"{stage}/{name}")

    try:
        ro = once(rolled_orders(orders, lines, columns), "orders_rolled")
        rc = once(rolled_customers(ro, customers, cutoff, thresholds, columns), "customers_rolled")
        write(flat_customer_documents(rc, columns), out["customers_flat"])
        write(rollup_documents(rc, ro, contacts, page_size, columns), out["customers"])
        if missing == "report":
            out["missing"] = f"{target}/missing"
            write(left_out, out["missing"])
    finally:
        for df in cached:
            df.unpersist()
        if not cache and not keep_stage:
            remove_path(spark, stage)
    if keep_stage and not cache:
        out["orders_rolled"] = f"{stage}/orders_rolled"
    return out
