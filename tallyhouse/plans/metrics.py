"""Named metrics over the gold tables: names in, a DataFrame query out.

``Model.query`` resolves names to columns with plain dictionaries, then builds one
aggregate per base table, joins only the dimensions that were asked for and leaves the
rest to Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.integrity import values_outside
from tallyhouse.operators.lookup import lookup, small
from tallyhouse.plans.summaries import AMOUNTS, COUNTS, GROUP, mean
from tallyhouse.streaming.jobs import MONTH, month_of


class UnknownName(KeyError):
    pass


class AmbiguousName(KeyError):
    pass


@dataclass(frozen=True)
class Metric:
    """``kind`` is one of sum, avg, count, count_distinct; ``column`` is empty for COUNT(*)."""

    kind: str
    column: str = ""
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Logical:
    """A gold table under the names its users know."""

    name: str
    key: str  # logical name of the primary key
    dimensions: Mapping[str, str]  # logical name -> column
    times: Mapping[str, str] = field(default_factory=dict)
    facts: Mapping[str, str] = field(default_factory=dict)
    metrics: Mapping[str, Metric] = field(default_factory=dict)
    synonyms: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    values: Mapping[str, tuple[str, ...]] = field(default_factory=dict)  # declared values of a dimension
    filters: Mapping[str, tuple[str, str, object]] = field(default_factory=dict)
    # Columns that hold each value once in this table: the tables are built from one row per
    # business key by joins that never repeat a row. Counting them needs no distinct shuffle.
    unique: frozenset[str] = frozenset()

    def columns(self) -> dict[str, str]:
        return {**self.dimensions, **self.times, **self.facts}


# ---------------------------------------------------------------------------------------
# Names, synonyms, declared values and definitions users ask for.
# ---------------------------------------------------------------------------------------

DIM_CUSTOMER = Logical(
    "dim_customer", "customer_key",
    dimensions={
        "customer_key": "customer_dim_key", "customer_id": "customer_id", "customer_number": "customer_number",
        "customer_name": "full_name", "first_name": "first_name", "last_name": "last_name", "gender": "gender",
        "email": "email", "city": "city", "state": "state_province", "country": "country_name",
        "country_code": "country_code", "region": "region", "customer_segment": "customer_segment",
        "loyalty_tier": "loyalty_tier", "is_active": "is_active"},
    times={"registration_date": "registration_date", "date_of_birth": "date_of_birth"},
    metrics={"customer_count": Metric("count_distinct", "customer_id", ("number of customers", "total customers"))},
    synonyms={
        "customer_name": ("client name", "buyer name"), "state": ("province", "state_province"),
        "region": ("geographic region", "customer region"), "customer_segment": ("segment", "market segment"),
        "loyalty_tier": ("loyalty level", "membership tier")},
    values={
        "gender": ("Male", "Female"), "region": ("AMER", "EMEA", "APAC", "JAPAN"),
        "customer_segment": ("Consumer", "Business"), "loyalty_tier": ("None", "Silver", "Gold", "Platinum")},
    unique=frozenset({"customer_id"}),
)

DIM_PRODUCT = Logical(
    "dim_product", "product_key",
    dimensions={
        "product_key": "product_dim_key", "sku_code": "sku_code", "variant": "variant", "price_tier": "price_tier",
        "model_code": "model_code", "model_name": "model_name", "lifecycle_status": "lifecycle_status",
        "family_code": "family_code", "family_name": "family_name", "category_code": "category_code",
        "category_name": "category_name", "reporting_segment": "reporting_segment"},
    times={"sku_launch_date": "sku_launch_date", "model_launch_date": "model_launch_date"},
    metrics={"product_count": Metric("count_distinct", "sku_code", ("number of products", "sku count"))},
    synonyms={
        "sku_code": ("sku", "product code", "item code"), "price_tier": ("pricing tier",),
        "model_name": ("product model", "model"), "lifecycle_status": ("product status",),
        "family_name": ("product family",), "category_name": ("product category", "category")},
    values={
        "price_tier": ("Standard", "Premium"), "lifecycle_status": ("ACTIVE", "DISCONTINUED"),
        "reporting_segment": ("Hardware", "Services", "Accessories")},
    unique=frozenset({"sku_code"}),
)

DIM_STORE = Logical(
    "dim_store", "store_key",
    dimensions={
        "store_key": "store_dim_key", "store_code": "store_code", "store_name": "store_name",
        "store_format": "format_code", "store_city": "city", "store_state": "state_code",
        "store_country": "country_code", "store_region": "region_code", "store_status": "lifecycle_status",
        "is_active": "is_active"},
    times={"store_open_date": "store_open_date"},
    facts={"floor_area_sqft": "floor_area_sqft", "annual_rent_usd": "annual_rent_usd"},
    metrics={
        "store_count": Metric("count_distinct", "store_code", ("number of stores", "total stores")),
        "total_floor_area": Metric("sum", "floor_area_sqft"),
        "total_annual_rent": Metric("sum", "annual_rent_usd")},
    synonyms={
        "store_name": ("store", "location name"), "store_format": ("format", "store type"), "store_city": ("city",),
        "store_state": ("state",)},
    values={"store_format": ("MALL", "MINI", "FLAGSHIP"), "store_status": ("ACTIVE", "CLOSED")},
    unique=frozenset({"store_code"}),
)

DIM_COUNTRY = Logical(
    "dim_country", "country_key",
    dimensions={
        "country_key": "country_dim_key", "country_code": "country_code", "country_name": "country_name",
        "region_code": "region_code", "region_name": "region_name", "currency_code": "currency_code",
        "currency_name": "currency_name", "currency_symbol": "currency_symbol", "tax_type": "tax_type",
        "market_tier": "market_tier"},
    facts={"tax_rate": "tax_rate"},
    metrics={"country_count": Metric("count_distinct", "country_code")},
    synonyms={"country_name": ("country",), "region_name": ("region", "geographic region")},
    values={
        "country_name": ("United States", "United Kingdom", "Japan", "China", "India"),
        "region_name": ("Americas", "Europe Middle East Africa", "Asia Pacific", "Japan"),
        "tax_type": ("VAT", "GST", "SALES_TAX")},
    unique=frozenset({"country_code"}),
)

DIM_DATE = Logical(
    "dim_date", "date_key",
    dimensions={
        "date_key": "date_dim_key", "year": "year_number", "quarter": "quarter_number",
        "quarter_name": "quarter_name", "month": "month_number", "month_name": "month_name", "week": "week_number",
        "day_of_week": "day_of_week", "day_name": "day_name", "year_month": "year_month",
        "year_quarter": "year_quarter", "fiscal_year": "fiscal_year", "fiscal_quarter": "fiscal_quarter",
        "is_weekend": "is_weekend"},
    times={"date": "date_key"},
    synonyms={
        "year": ("calendar year",), "quarter": ("calendar quarter",), "month": ("month number",),
        "month_name": ("month",), "week": ("week number", "week of year"), "fiscal_year": ("fy",),
        "fiscal_quarter": ("fq",), "date": ("calendar date", "transaction date")},
    values={"quarter_name": ("Q1", "Q2", "Q3", "Q4")},
)

FACT_SALES_HEADER = Logical(
    "fact_sales_header", "fact_header_key",
    dimensions={
        "fact_header_key": "fact_sales_header_key", "customer_dim_key": "customer_dim_key",
        "store_dim_key": "store_dim_key", "country_dim_key": "country_dim_key", "date_dim_key": "date_dim_key",
        "transaction_id": "transaction_id", "transaction_number": "transaction_number", "channel": "channel_id",
        "payment_method": "payment_method", "currency": "currency"},
    times={"transaction_date": "transaction_timestamp"},
    facts={"gross_amount": "gross_amount", "discount_amount": "total_discount", "tax_amount": "total_tax",
           "net_amount": "net_total"},
    metrics={
        "total_transactions": Metric("count_distinct", "transaction_id",
                                     ("transaction count", "number of transactions", "order count")),
        "total_gross_sales": Metric("sum", "gross_amount", ("gross sales", "gross revenue")),
        "total_discounts": Metric("sum", "total_discount", ("discount total",)),
        "total_tax": Metric("sum", "total_tax", ("tax total",)),
        "total_net_sales": Metric("sum", "net_total",
                                  ("net sales", "net revenue", "total sales", "sales by region", "sales by country",
                                   "sales by store", "sales by customer")),
        "average_transaction_value": Metric("avg", "net_total",
                                            ("avg order value", "average basket size", "atv"))},
    synonyms={
        "transaction_number": ("order number", "receipt number"), "channel": ("sales channel",),
        "payment_method": ("payment type",), "transaction_date": ("sale date", "order date")},
    values={"channel": ("POS", "WEB")},
    filters={"pos_sales": ("channel", "=", "POS"), "web_sales": ("channel", "=", "WEB")},
    unique=frozenset({"transaction_id"}),
)

FACT_SALES_ITEM = Logical(
    "fact_sales_item", "fact_item_key",
    dimensions={
        "fact_item_key": "fact_sales_item_key", "fact_header_key": "fact_sales_header_key",
        "customer_dim_key": "customer_dim_key", "product_dim_key": "product_dim_key",
        "store_dim_key": "store_dim_key", "country_dim_key": "country_dim_key", "date_dim_key": "date_dim_key",
        "line_id": "transaction_line_id", "transaction_id": "transaction_id", "channel": "channel_id"},
    times={"transaction_date": "transaction_timestamp"},
    facts={"quantity": "quantity", "unit_price": "unit_price", "line_discount": "discount_amount",
           "line_tax": "tax_amount", "line_total": "line_total"},
    metrics={
        "total_units_sold": Metric("sum", "quantity", ("units sold", "quantity sold", "total quantity")),
        "total_line_revenue": Metric("sum", "line_total",
                                     ("product revenue", "item revenue", "revenue by product", "product sales")),
        "total_line_discounts": Metric("sum", "discount_amount"),
        "total_line_tax": Metric("sum", "tax_amount"),
        "average_unit_price": Metric("avg", "unit_price", ("avg price", "average selling price")),
        "total_line_items": Metric("count", "", ("line count",))},
)

# name, from table and its column, to table and its column (logical names)
RELATIONSHIPS = (
    ("header_to_customer", "fact_sales_header", "customer_dim_key", "dim_customer", "customer_key"),
    ("header_to_store", "fact_sales_header", "store_dim_key", "dim_store", "store_key"),
    ("header_to_country", "fact_sales_header", "country_dim_key", "dim_country", "country_key"),
    ("header_to_date", "fact_sales_header", "date_dim_key", "dim_date", "date_key"),
    ("item_to_header", "fact_sales_item", "fact_header_key", "fact_sales_header", "fact_header_key"),
    ("item_to_product", "fact_sales_item", "product_dim_key", "dim_product", "product_key"),
    ("item_to_customer", "fact_sales_item", "customer_dim_key", "dim_customer", "customer_key"),
    ("item_to_store", "fact_sales_item", "store_dim_key", "dim_store", "store_key"),
    ("item_to_country", "fact_sales_item", "country_dim_key", "dim_country", "country_key"),
    ("item_to_date", "fact_sales_item", "date_dim_key", "dim_date", "date_key"),
)

LOGICAL = {t.name: t for t in (DIM_CUSTOMER, DIM_PRODUCT, DIM_STORE, DIM_COUNTRY, DIM_DATE, FACT_SALES_HEADER,
                               FACT_SALES_ITEM)}

# ---------------------------------------------------------------------------------------

_COMPARE: dict[str, Callable[[Column, object], Column]] = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(*v),
    "between": lambda c, v: c.between(*v),
}

Condition = tuple[str, str, object]


def relationship(left: str, right: str) -> tuple[str, str]:
    """Columns that join table ``left`` to table ``right``."""
    for _, source, source_name, target, target_name in RELATIONSHIPS:
        if (source, target) == (left, right):
            return LOGICAL[left].columns()[source_name], LOGICAL[right].columns()[target_name]
    raise UnknownName(f"{left} has no relationship to {right}")


def reachable(base: str) -> list[str]:
    return [base, *[target for _, source, _, target, _ in RELATIONSHIPS if source == base]]


class Model:
    """Questions over gold tables; ``table`` gives a gold table by name.

    Distinct counts count distinct values. With ``assume_unique`` columns that hold each
    value once in tables built here are counted plainly, which any other tables may not allow.

    ``groups`` gives the stored sums of a day and place, made from the transaction fact that
    ``table`` gives. Questions that those can answer in full are answered from them.
    """

    def __init__(self, table: Callable[[str], DataFrame], assume_unique: bool = False, groups: Callable[[], DataFrame] | None = None):
        self.table, self.assume_unique, self.groups = table, assume_unique, groups

    # -- names ---------------------------------------------------------------------

    def find_metric(self, name: str) -> tuple[str, str, Metric]:
        """Table, name and definition of a metric, by ``name``, ``table.name`` or synonym."""
        table, _, bare = name.rpartition(".")
        hits = [(t.name, n, m) for t in LOGICAL.values() if table in ("", t.name)
                for n, m in t.metrics.items() if bare == n or bare in m.synonyms]
        return _single(name, hits)

    def find_column(self, name: str, bases: Iterable[str]) -> tuple[str, str]:
        """Table and logical name of a dimension, for queries on all of ``bases``.

        A dimension of the base table itself comes first, then those of related tables;
        a bare name that fits several of them is refused.
        """
        table, _, bare = name.rpartition(".")
        tables = [table] if table else [
            t for t in LOGICAL if all(t in reachable(b) for b in bases)] or [t for b in bases for t in reachable(b)]
        if table and table not in LOGICAL:
            raise UnknownName(name)
        for group in ([t for t in tables if t in bases], [t for t in tables if t not in bases]):
            hits = [(t, n) for t in group for n in LOGICAL[t].columns()
                    if bare == n or (bare in LOGICAL[t].synonyms.get(n, ()))]
            if table:
                hits = [h for h in hits if h[1] == bare] or hits
            if len({n for _, n in hits}) == 1 and all(t in bases for t, _ in hits):
                return hits[0]
            if hits:
                return _single(name, hits)
        raise UnknownName(name)

    # -- queries -------------------------------------------------------------------

    def query(
        self,
        metrics: Sequence[str] | Mapping[str, str | Metric],
        by: Sequence[str] | Mapping[str, str] = (),
        filters: Sequence[str | Condition] = (),
        order_by: Sequence[str] = (),
        limit: int | None = None,
        base: str | None = None,
        broadcast_bytes: int | None = None,
    ) -> DataFrame:
        """Metrics grouped by dimensions.

        ``metrics`` and ``by`` are names, or output name -> name. ``filters`` are named
        filters or (dimension, operator, value). ``order_by`` takes output names, with a
        leading ``-`` for descending; a limit adds the group columns as tie-break.
        Metrics of several tables are aggregated each on their own table and meet on the
        group columns, so lines never multiply transactions.
        """
        wanted = metrics if isinstance(metrics, Mapping) else {m.rpartition(".")[2]: m for m in metrics}
        groups = by if isinstance(by, Mapping) else {b.rpartition(".")[2]: b for b in by}
        per_base: dict[str, dict[str, Metric]] = {}
        for alias, metric in wanted.items():
            if isinstance(metric, Metric):
                table, found = base, metric
            else:
                table, _, found = self.find_metric(metric)
            per_base.setdefault(table, {})[alias] = found
        parts = [self._aggregate(t, list(per_base), found, groups, filters, broadcast_bytes) for t, found in per_base.items()]
        out = parts[0]
        if len(parts) > 1:
            for part in parts[1:]:
                out = out.unionByName(part, allowMissingColumns=True)
            out = out.groupBy(*groups).agg(*[F.max(a).alias(a) for a in wanted])
        out = out.select(*groups, *wanted)
        order = list(order_by)
        if limit is not None:
            order += [g for g in groups if g not in order and f"-{g}" not in order]
        if order:
            out = out.orderBy(*[
                F.desc_nulls_first(o[1:]) if o.startswith("-") else F.asc_nulls_last(o) for o in order])
        return out if limit is None else out.limit(limit)

    def rows(self, table: str, names: Sequence[str] = ()) -> DataFrame:
        """A gold table under its logical names: dimensions, time dimensions and row facts."""
        columns = LOGICAL[table].columns()
        return self.table(table).select(*[F.col(columns[n]).alias(n) for n in (names or columns)])

    def undeclared_values(self, declared: Mapping[str, Mapping[str, Sequence[str]]] | None = None) -> DataFrame:
        """Values that occur in the data but not in the declared list of their dimension.

        ``declared`` adds lists that belong to one company, such as its category names, as
        table -> dimension -> values.
        """
        parts = []
        for logical in LOGICAL.values():
            for name, allowed in {**logical.values, **(declared or {}).get(logical.name, {})}.items():
                found = values_outside(self.table(logical.name), logical.dimensions[name], allowed)
                parts.append(found.select(
                    F.lit(logical.name).alias("table_name"), F.lit(name).alias("dimension"), "value", "rows"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    # -- building blocks -------------------------------------------------------------

    def _aggregate(self, base, bases, metrics, groups, filters, broadcast_bytes) -> DataFrame:
        """One aggregate over one base table.

        Dimensions small enough to broadcast are joined first. If others are left and all
        metrics can be computed in two steps, the rows are added up per key of those before
        the join: a customer with a third of all sales then enters the shuffle as one row
        per task, and the join sees customers instead of sales.
        """
        conditions = [self._condition(f) for f in filters]
        names = {alias: self._locate(name, base, bases) for alias, name in groups.items()}
        tests = [(self._locate(n, base, bases), op, value) for n, op, value in conditions]
        used: dict[str, list[str]] = {}
        for table, name in [*names.values(), *[place for place, _, _ in tests]]:
            used.setdefault(table, []).append(name)
        others = {t: self._dimension(base, t, found) for t, found in used.items() if t != base}
        late = {t: o for t, o in others.items() if not small(o, broadcast_bytes)}

        def column(place: tuple[str, str]) -> str:
            table, name = place
            return LOGICAL[table].columns()[name] if table == base else f"{table}__{name}"

        def kept(df: DataFrame, now: Callable[[str], bool]) -> DataFrame:
            for place, op, value in tests:
                if now(place[0]):
                    df = df.filter(_COMPARE[op](F.col(column(place)), value))
            return df

        measure = self._measure
        if self.groups is not None and self._in_groups(base, metrics, [*names.values(), *[place for place, _, _ in tests]]):
            rows, measure, late = self.groups(), _of_groups, {}
        else:
            rows = self.table(base)
        df = self._in_months(base, tests, rows)
        for table, other in others.items():
            if table not in late:
                df = lookup(df, other, relationship(base, table)[0], broadcast_bytes=broadcast_bytes)
        df = kept(df, lambda table: table not in late)
        by = [F.col(column(p)).alias(a) for a, p in names.items()]
        if not late:
            kinds = {f.name: f.dataType for f in df.schema.fields}
            return df.groupBy(*by).agg(*[(measure(m, kinds) if measure is _of_groups else measure(base, m)).alias(a) for a, m in metrics.items()])
        in_two = not any(self._is_distinct(base, m) for m in metrics.values())
        if in_two:
            early = [column(p) for p in names.values() if p[0] not in late]
            keys = dict.fromkeys([*[relationship(base, t)[0] for t in late], *early])
            df = df.groupBy(*keys).agg(*[c for a, m in metrics.items() for c in _first_step(a, m)])
        for table, other in late.items():
            df = lookup(df, other, relationship(base, table)[0], broadcast_bytes=broadcast_bytes)
        grouped = kept(df, lambda table: table in late).groupBy(*by)
        return grouped.agg(*[
            (_second_step(a, m) if in_two else self._measure(base, m)).alias(a) for a, m in metrics.items()])

    def _in_groups(self, base: str, metrics: Mapping[str, Metric], places: Sequence[tuple[str, str]]) -> bool:
        """Whether the stored groups answer a question: they hold its metrics, and all it groups and filters by.

        Transactions are counted, not made distinct: the groups are made from a fact that
        holds each once.
        """
        columns = {LOGICAL[t].columns()[n] for t, n in places if t == base}
        held = {
            "sum": lambda c: c in AMOUNTS.values(), "avg": lambda c: c in AMOUNTS.values(), "count": lambda c: not c,
            "count_distinct": lambda c: c in LOGICAL[base].unique}
        return (base == "fact_sales_header" and columns <= set(GROUP) and {t for t, _ in places} <= {base, "dim_date", "dim_store", "dim_country"}
                and all(held[m.kind](m.column) for m in metrics.values()))

    def _in_months(self, base: str, tests: Sequence[tuple[tuple[str, str], str, object]], df: DataFrame) -> DataFrame:
        """The base table, or its stored groups, cut down to the months that conditions on its time leave.

        The months that a condition on the days allows are looked up in the date dimension,
        a row a day, and become a condition on the column that the table is split by.
        """
        days = [(LOGICAL["dim_date"].columns()[n], op, v) for (t, n), op, v in tests if t == "dim_date"]
        own = [("date_key", op, v) for (t, n), op, v in tests if t == base and LOGICAL[base].columns()[n] == "transaction_timestamp"]
        if MONTH not in df.columns or not days + own:
            return df
        allowed = self.table("dim_date")
        for column, op, value in days + own:
            allowed = allowed.filter(_COMPARE[op](F.col(column), value))
        months = [r[0] for r in allowed.select(month_of("date_key")).distinct().collect()]
        return df.filter(F.col(MONTH).isin(months))

    def _locate(self, name: str, base: str, bases: Sequence[str]) -> tuple[str, str]:
        """Where ``base`` finds a dimension: in itself if it carries the same name."""
        table, column = self.find_column(name, bases)
        if table != base and table in bases and column in LOGICAL[base].columns():
            table = base
        if table not in reachable(base):
            if column in LOGICAL[base].columns():
                return base, column
            raise UnknownName(f"{base} cannot be grouped or filtered by {table}.{column}")
        return table, column

    def _condition(self, item: str | Condition) -> Condition:
        if not isinstance(item, str):
            return item
        for logical in LOGICAL.values():
            if item in logical.filters:
                return logical.filters[item]
        raise UnknownName(item)

    def _dimension(self, base: str, table: str, names: Sequence[str]) -> DataFrame:
        """Key and wanted columns of a related table, named so that they cannot clash."""
        left, right = relationship(base, table)
        columns = LOGICAL[table].columns()
        return self.table(table).select(
            F.col(right).alias(left), *[F.col(columns[n]).alias(f"{table}__{n}") for n in dict.fromkeys(names)])

    def _is_distinct(self, base: str, metric: Metric) -> bool:
        """Whether a metric really needs distinct values."""
        return metric.kind == "count_distinct" and not (self.assume_unique and metric.column in LOGICAL[base].unique)

    def _measure(self, base: str, metric: Metric) -> Column:
        if metric.kind == "count_distinct":
            return F.countDistinct(metric.column) if self._is_distinct(base, metric) else F.count(metric.column)
        if metric.kind == "avg":
            return mean(metric.column)
        if metric.kind == "count":
            return F.count(F.col(metric.column) if metric.column else F.lit(1))
        return F.sum(metric.column)


def _of_groups(metric: Metric, kinds: Mapping[str, T.DataType]) -> Column:
    """The metric from the sums and counts of stored groups."""
    if metric.kind in ("count", "count_distinct"):
        return F.coalesce(F.sum("transaction_count"), F.lit(0))
    total = next(t for t, a in AMOUNTS.items() if a == metric.column)
    added = F.sum(total).cast(kinds[total])
    return added if metric.kind == "sum" else added.cast("double") / F.nullif(F.sum(COUNTS[total]), F.lit(0))


def _first_step(alias: str, metric: Metric) -> list[Column]:
    """Sum and count of a metric within one key."""
    counted = F.count(F.col(metric.column) if metric.column else F.lit(1)).alias(f"{alias}__n")
    return [counted, F.sum(metric.column).alias(f"{alias}__sum")] if metric.kind in ("sum", "avg") else [counted]


def _second_step(alias: str, metric: Metric) -> Column:
    """The metric from the sums and counts of its keys."""
    if metric.kind == "sum":
        return F.sum(f"{alias}__sum")
    if metric.kind == "avg":
        return F.sum(f"{alias}__sum").cast("double") / F.nullif(F.sum(f"{alias}__n"), F.lit(0))
    return F.coalesce(F.sum(f"{alias}__n"), F.lit(0))


def _single(name: str, hits: list) -> tuple:
    if not hits:
        raise UnknownName(name)
    if len(hits) > 1:
        raise AmbiguousName(f"{name} fits {', '.join('.'.join(h[:2]) for h in hits)}")
    return hits[0]
