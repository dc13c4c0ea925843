"""Named business fields and metrics over the invoice header and line tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, functions as F

from docflow.operators.analytics import exact_avg

HEADER, LINES, LINK = "invoice", "invoice_detail", "invoice_id"
DEFAULT_MODEL = Path(__file__).parent.parent / "plans" / "invoice_model.yaml"


@dataclass(frozen=True)
class Item:
    """A fact or dimension: a named column of one table."""

    name: str
    table: str
    column: str
    kind: str = "dimension"
    synonyms: tuple[str, ...] = ()
    comment: str = ""


@dataclass(frozen=True)
class Metric:
    name: str
    table: str = ""
    agg: str = ""
    column: str = ""
    ratio: tuple[str, ...] = ()


@dataclass
class SemanticModel:
    name: str
    keys: dict[str, str]
    items: list[Item]
    metrics: dict[str, Metric]
    relationships: list[dict] = field(default_factory=list)

    @classmethod
    def from_yaml(cls, path: str | Path = DEFAULT_MODEL) -> "SemanticModel":
        doc = yaml.safe_load(Path(path).read_text())
        items = [
            Item(d["name"], d["table"], d["column"], kind, tuple(d.get("synonyms", ())), d.get("comment", ""))
            for kind, block in (("fact", "facts"), ("dimension", "dimensions")) for d in doc[block]
        ]
        # Keys can always be asked for.
        items += [Item(LINK, HEADER, LINK, "key"), Item("invoice_detail_id", LINES, "invoice_detail_id", "key")]
        metrics = {
            m["name"]: Metric(m["name"], m.get("table", ""), m.get("agg", ""), m.get("column", ""), tuple(m.get("ratio", ())))
            for m in doc["metrics"]
        }
        return cls(doc["name"], {t: v["key"] for t, v in doc["tables"].items()}, items, metrics, doc["relationships"])

    def candidates(self, name: str) -> list[Item]:
        """All items a name or synonym may mean; ``table.name`` narrows to one table."""
        table, _, rest = name.rpartition(".")
        wanted = rest.strip().lower()
        pool = [i for i in self.items if not table or i.table == table]
        exact = [i for i in pool if i.name.lower() == wanted]
        return exact or [i for i in pool if wanted in {s.lower() for s in i.synonyms}]

    def resolve(self, name: str) -> Item:
        found = self.candidates(name)
        if not found:
            raise KeyError(f"unknown field: {name}")
        if len(found) > 1:
            raise ValueError(f"ambiguous field {name}: " + ", ".join(f"{i.table}.{i.name}" for i in found))
        return found[0]

    def field_list(self) -> list[tuple]:
        return [(i.name, i.table, i.kind, i.column, s) for i in self.items for s in (i.synonyms or ("",))]


def _finish(agg: str, column: Column) -> Column:
    if agg == "sum":
        return F.sum(column).cast("decimal(38,2)")
    if agg == "avg":
        return exact_avg(column)
    return {"count": F.count, "min": F.min, "max": F.max}[agg](column)


def _condition(model: SemanticModel, rule: tuple) -> tuple[str, Column]:
    name, op, value = rule
    item = model.resolve(name)
    c = F.col(item.column)
    ops = {
        "=": lambda: c == value, "!=": lambda: c != value, ">": lambda: c > value, ">=": lambda: c >= value,
        "<": lambda: c < value, "<=": lambda: c <= value, "like": lambda: c.like(value),
        "ilike": lambda: c.ilike(value), "in": lambda: c.isin(*value),
    }
    return item.table, ops[op]()


def semantic_query(
    model: SemanticModel, tables: dict[str, DataFrame], dims: list[str | tuple[str, str]] = (),
    metrics: list[str | tuple[str, str, str]] = (), where: list[tuple] = (),
    order_by: list[tuple[str, bool]] = (), limit: int | None = None,
) -> DataFrame:
    """Dimensions and metrics by name or synonym.

    ``dims`` may carry a truncation, ``("invoice_date", "month")``; ``metrics`` may be given
    as ``(alias, agg, fact)``. Lines are first reduced to one row per invoice and line
    dimension, then left-joined to the header, so a header value is counted once per invoice
    and group whatever the number of lines. Without metrics the rows themselves are returned.
    """
    rules = [_condition(model, r) for r in where]
    head_rules = [c for table, c in rules if table == HEADER]
    line_rules = [c for table, c in rules if table == LINES]
    header, lines = tables[HEADER], tables[LINES]
    for rule in head_rules:
        header = header.filter(rule)
    for rule in line_rules:
        lines = lines.filter(rule)
    how = "inner" if line_rules else "left"

    wanted = [(d, None) if isinstance(d, str) else d for d in dims]
    dim_items = [(model.resolve(name), unit) for name, unit in wanted]
    line_dims = [i for i, _ in dim_items if i.table == LINES]

    def out(i: Item, unit: str | None) -> Column:
        c = F.col(("_d_" if i.table == LINES else "") + i.column)
        return (F.trunc(c, unit) if unit else c).alias(i.name)

    if not metrics:
        if not line_dims and not line_rules:
            result = header.select(*[out(i, u) for i, u in dim_items])
        else:
            used = sorted({i.column for i in line_dims})
            rows = lines.select(LINK, *[F.col(c).alias(f"_d_{c}") for c in used])
            result = header.join(rows, LINK, how).select(*[out(i, u) for i, u in dim_items])
        return _sorted(result, order_by, limit)

    asked = []
    for m in metrics:
        if isinstance(m, tuple):
            alias, agg, fact = m
            item = model.resolve(fact)
            asked.append(Metric(alias, item.table, agg, item.column))
        else:
            asked.append(model.metrics[m])
    base = {m.name: m for m in asked if not m.ratio}
    for m in asked:
        for part in m.ratio:
            base.setdefault(part, model.metrics[part])

    line_metrics = [m for m in base.values() if m.table == LINES]
    frame = header
    if line_dims or line_metrics or line_rules:
        partials = []
        for m in line_metrics:
            # A table's key is never NULL: counting it is counting rows, and it need not be read.
            c = F.lit(1) if m.agg == "count" and m.column == model.keys[LINES] else F.col(m.column)
            if m.agg in ("count", "avg"):
                partials.append(F.count(c).alias(f"_n_{m.name}"))
            if m.agg in ("sum", "avg"):
                partials.append(F.sum(c).alias(f"_s_{m.name}"))
            if m.agg in ("min", "max"):
                partials.append(_finish(m.agg, c).alias(f"_m_{m.name}"))
        keys = [F.col(c).alias(f"_d_{c}") for c in sorted({i.column for i in line_dims})]
        per = lines.groupBy(LINK, *keys).agg(*(partials or [F.lit(1).alias("_any")]))
        frame = header.join(per, LINK, how)

    aggs = []
    for m in base.values():
        if m.table == HEADER:
            value = _finish(m.agg, F.col(m.column))
        elif m.agg == "count":
            value = F.coalesce(F.sum(f"_n_{m.name}"), F.lit(0))
        elif m.agg == "sum":
            value = F.sum(f"_s_{m.name}").cast("decimal(38,2)")
        elif m.agg == "avg":
            value = F.try_divide(F.sum(f"_s_{m.name}"), F.sum(f"_n_{m.name}")).cast("decimal(22,6)")
        else:
            value = {"min": F.min, "max": F.max}[m.agg](f"_m_{m.name}")
        aggs.append(value.alias(m.name))
    grouped = frame.groupBy(*[out(i, u) for i, u in dim_items]).agg(*aggs)
    columns = [i.name for i, _ in dim_items]
    for m in asked:
        if m.ratio:
            top, bottom = (F.col(p).cast("double") for p in m.ratio)
            columns.append(F.round(F.try_divide(top, bottom), 6).alias(m.name))
        else:
            columns.append(m.name)
    return _sorted(grouped.select(*columns), order_by, limit)


def _sorted(df: DataFrame, order_by, limit) -> DataFrame:
    if order_by:
        df = df.orderBy(*[F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order_by])
    return df.limit(limit) if limit else df


# ---- ready questions; calendar periods relative to ``as_of`` --------------------------


def _month(as_of: str, back: int) -> Column:
    return F.add_months(F.trunc(F.lit(as_of).cast("date"), "MONTH"), -back)


def _quarter(as_of: str, back: int) -> Column:
    return F.add_months(F.trunc(F.lit(as_of).cast("date"), "QUARTER"), -3 * back)


INVOICE_ROW = ["invoice_number", "vendor_name", "customer_name", "invoice_date", "total_amount", "currency"]


def invoices_last_month(model, tables, as_of):
    return semantic_query(model, tables, INVOICE_ROW, where=[
        ("invoice_date", ">=", _month(as_of, 1)), ("invoice_date", "<", _month(as_of, 0))])


def vendor_revenue(model, tables, vendor):
    return semantic_query(model, tables, ["vendor_name"], ["total_revenue"], [("vendor_name", "=", vendor)])


def top_customers(model, tables, limit=10):
    return semantic_query(model, tables, ["customer_name"], ["total_revenue"],
                          order_by=[("total_revenue", True), ("customer_name", False)], limit=limit)


def overdue_invoices(model, tables, as_of):
    return semantic_query(model, tables, ["invoice_number", "vendor_name", "due_date", "total_amount"],
                          where=[("due_date", "<", F.lit(as_of).cast("date"))])


def common_items(model, tables, limit=10):
    return semantic_query(model, tables, ["item_description"], ["total_line_items"],
                          order_by=[("total_line_items", True), ("item_description", False)], limit=limit)


def average_by_vendor(model, tables):
    return semantic_query(model, tables, ["vendor_name"], ["average_invoice_value"])


def lines_of_invoice(model, tables, number):
    return semantic_query(model, tables, ["invoice_number", "line_number", "item_description", "quantity", "line_amount"],
                          where=[("invoice_number", "=", number), ("line_number", ">=", 0)])


def tax_this_quarter(model, tables, as_of):
    return semantic_query(model, tables, [], ["total_tax_collected"], [
        ("invoice_date", ">=", _quarter(as_of, 0)), ("invoice_date", "<", _quarter(as_of, -1))])


def vendors_by_frequency(model, tables):
    return semantic_query(model, tables, ["vendor_name"], ["total_invoices"])


def shipping_above(model, tables, amount=100):
    return semantic_query(model, tables, ["invoice_number", "vendor_name", "shipping_amount"],
                          where=[("shipping_amount", ">", amount)])


def last_quarter_above(model, tables, as_of, amount=10000):
    return semantic_query(model, tables, INVOICE_ROW, where=[
        ("invoice_date", ">=", _quarter(as_of, 1)), ("invoice_date", "<", _quarter(as_of, 0)),
        ("total_amount", ">", amount)])


def average_by_month(model, tables):
    return semantic_query(model, tables, [("invoice_date", "month")], ["average_invoice_value"])


def lines_for_products(model, tables, pattern):
    return semantic_query(model, tables, ["invoice_number", "line_number", "item_description", "line_amount"],
                          where=[("item_description", "ilike", pattern)])


def top_vendors_last_month(model, tables, as_of, limit=5):
    return semantic_query(model, tables, ["vendor_name"], ["total_revenue"], [
        ("invoice_date", ">=", _month(as_of, 1)), ("invoice_date", "<", _month(as_of, 0))],
        order_by=[("total_revenue", True), ("vendor_name", False)], limit=limit)
