"""Mart pipelines: channel P&L, sales analysis, primary sales, agent tables, inventory."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.money import halves, scale_of, units, whole
from martloom.operators.asof import join_nearest_snapshots
from martloom.operators.change import replace_slice
from martloom.operators.dedup import keep_last
from martloom.operators.skew import lookup_join, null_high, one_per_key

CHANNEL_KEYS = ["store", "orderdate", "marketingtype", "marketingsource", "marketingchannel"]

# What sessions without a mapping count as.
DEFAULT_TYPE, DEFAULT_CHANNEL, DEFAULT_SOURCE = "CORE", "UNPAID", "DIRECT"


def channel_mapping(mapping: DataFrame) -> DataFrame:
    """One upper-cased row per source / medium; duplicates settle by channel, type, source."""
    upper = mapping.select(
        F.upper("source_medium").alias("source_medium"),
        F.upper("channel").alias("channel"),
        F.upper("type").alias("type"),
        F.upper("source").alias("source"),
    )
    return one_per_key(upper, ["source_medium"], null_high("channel", "type", "source"), "first")


def channel_sessions(
    stores: Mapping[str, DataFrame], mapping: DataFrame, measure: str
) -> DataFrame:
    """Sessions per store, date and marketing type, source and channel.

    Summed per source / medium before the mapping lookup, so only the summed rows are joined.
    """
    parts = [
        df.select(
            F.concat(F.upper("session_source"), F.lit(" / "), F.upper("session_medium")).alias(
                "source_medium"
            ),
            F.col("date").cast("date").alias("orderdate"),
            F.lit(store).alias("store"),
            F.col(measure).alias("sessions"),
        )
        for store, df in stores.items()
    ]
    every = reduce(DataFrame.unionByName, parts)
    summed = every.groupBy("source_medium", "orderdate", "store").agg(
        F.sum("sessions").alias("sessions")
    )
    mapped = lookup_join(summed, channel_mapping(mapping), ["source_medium"])
    return mapped.groupBy(
        "store",
        "orderdate",
        F.coalesce("type", F.lit(DEFAULT_TYPE)).alias("marketingtype"),
        F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("marketingsource"),
        F.coalesce("channel", F.lit(DEFAULT_CHANNEL)).alias("marketingchannel"),
    ).agg(F.sum("sessions").alias("total_sessions"))


def _upper_status() -> Column:
    return F.upper("orderstatus")


def _channel_orders(lines: DataFrame, sums: Sequence[str], extra: Mapping[str, Column]) -> DataFrame:
    """Order lines to channel totals in two steps: per order and customer, then per channel group.

    The first step shuffles by group and order, so a channel group that holds a third of the
    lines is spread, and the distinct counts run over orders instead of lines.
    """
    counted = (
        (F.col("quantity") != 0) & (_upper_status() != "SHIPPED & RETURNED")
    ) | F.col("orderstatus").isNull()
    cancelled = _upper_status() == "CANCELLED"
    measures = lines.withColumns(dict(extra)) if extra else lines
    scales = {c: scale_of(measures, c) for c in [*sums, *extra]}

    def sums_of(c: str) -> list[Column]:
        if scales[c] is None:
            return [F.sum(c).alias(c)]
        high, low = halves(units(F.col(c), scales[c]))
        return [F.sum(high).alias(f"_high_{c}"), F.sum(low).alias(f"_low_{c}")]

    def parts_of(c: str) -> list[str]:
        return [c] if scales[c] is None else [f"_high_{c}", f"_low_{c}"]

    dated = measures.withColumn("orderdate", F.col("orderdate").cast("date"))
    per_order = (
        dated.groupBy(*CHANNEL_KEYS, "ordername", "phone")
        .agg(
            F.max(counted).alias("_counted"),
            F.max(cancelled).alias("_cancelled"),
            F.max(F.col("new_customer") == "TRUE").alias("_new"),
            *[part for c in scales for part in sums_of(c)],
        )
    )

    # Two distinct columns with conditions, not four distinct expressions, and the halves once more:
    # the counts' hash table has a row per order and customer, each with the buffers of all sums.
    summed = per_order.groupBy(*CHANNEL_KEYS).agg(
        F.expr("count(DISTINCT ordername) FILTER (WHERE _counted)").alias("total_order"),
        F.expr("count(DISTINCT phone) FILTER (WHERE _new)").alias("new_customer"),
        F.count_distinct("phone").alias("total_customer"),
        F.expr("count(DISTINCT ordername) FILTER (WHERE _cancelled)").alias("canc_orders"),
        *[F.sum(part).alias(part) for c in scales for part in parts_of(c)],
    )

    def total(c: str) -> Column:
        value = F.col(c)
        if scales[c] is not None:
            value = whole(F.col(f"_high_{c}"), F.col(f"_low_{c}"), scales[c])
            value = value.cast(f"decimal(38,{scales[c]})")
        return F.coalesce(value, F.lit(0)).alias(c)

    counts = ["total_order", "new_customer", "total_customer", "canc_orders"]
    totals = summed.select(*CHANNEL_KEYS, *counts, *[total(c) for c in scales])
    # MAX of a text would turn the hash aggregates above into sorts of every line. The brands are
    # few, so their own narrow pass ends in a small join.
    brands = dated.select(*CHANNEL_KEYS, "brandname").distinct()
    top = brands.groupBy(*CHANNEL_KEYS).agg(F.max("brandname").alias("brandname"))
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) for k in CHANNEL_KEYS]
    return totals.alias("t").join(top.alias("b"), same, "left").select("t.*", "b.brandname")


def _with_sessions(orders: DataFrame, sessions: DataFrame) -> DataFrame:
    joined = orders.join(sessions, CHANNEL_KEYS, "left")
    return joined.withColumn("total_sessions", F.coalesce("total_sessions", F.lit(0).cast("bigint")))


def channel_pnl(
    lines: DataFrame, stores: Mapping[str, DataFrame], mapping: DataFrame
) -> DataFrame:
    """Profit and loss per store, date and marketing channel, with sessions."""
    sums = [
        "mrpsales", "grosssales", "mrpdiscount", "cancelledsales", "quantity",
        "allocated_marketing_spend", "affiliatemarketingspend", "shipping_price", "rtosales",
        "tax", "netsales", "cogs", "logisticscost", "cm1", "cm2",
    ]
    totals = _with_sessions(
        _channel_orders(lines, sums, {}), channel_sessions(stores, mapping, "sessions")
    )
    cents = {
        "allocated_marketing_spend": "allocated_marketing_spend",
        "affiliated_marketing_spend": "affiliatemarketingspend",
        "shipping_price": "shipping_price",
        "rtosales": "rtosales",
        "tax": "tax",
        "netsales": "netsales",
        "cogs": "cogs",
        "logistics": "logisticscost",
        "cm1": "cm1",
        "cm2": "cm2",
    }
    return totals.select(
        *CHANNEL_KEYS,
        "brandname",
        "mrpsales",
        F.col("grosssales").alias("total_gross"),
        F.col("mrpdiscount").alias("total_discount"),
        F.round(F.col("grosssales") - F.col("cancelledsales")).alias("totalsales_ex_canc"),
        "total_order",
        F.col("quantity").alias("total_quantity"),
        "new_customer",
        "total_customer",
        "canc_orders",
        *[F.round(c, 2).alias(name) for name, c in cents.items()],
        "total_sessions",
    )


def sales_analysis(
    lines: DataFrame, stores: Mapping[str, DataFrame], mapping: DataFrame
) -> DataFrame:
    """Sales per store, date and marketing channel, with engaged sessions."""
    sums = [
        "grosssales", "mrpdiscount", "cancelledsales", "quantity", "allocated_marketing_spend",
        "affiliatemarketingspend",
    ]
    cancelled = F.when(_upper_status() == "CANCELLED", F.col("quantity")).otherwise(0)
    totals = _with_sessions(
        _channel_orders(lines, sums, {"canc_quantity": cancelled}),
        channel_sessions(stores, mapping, "engaged_sessions"),
    )
    return totals.select(
        *CHANNEL_KEYS,
        "brandname",
        F.col("grosssales").alias("total_gross"),
        F.col("mrpdiscount").alias("total_discount"),
        F.round(F.col("grosssales") - F.col("cancelledsales")).alias("totalsales_ex_canc"),
        "total_order",
        F.col("quantity").alias("total_quantity"),
        F.round("allocated_marketing_spend", 2).alias("allocated_marketing_spend"),
        F.round("affiliatemarketingspend", 2).alias("affiliated_marketing_spend"),
        "new_customer",
        "total_customer",
        "canc_orders",
        "canc_quantity",
        "total_sessions",
    )


def newest_first(df: DataFrame) -> DataFrame:
    """Display order of the channel marts."""
    return df.orderBy(F.desc_nulls_first("orderdate"), F.desc_nulls_first("total_gross"))


# --- primary sales -------------------------------------------------------------------------

SALES_COLUMNS = {
    "product_code": "string", "whsku": "string", "whsku_key": "string",
    "quantity": "decimal(18,2)", "orderid": "string", "externalordernumber": "string",
    "invoicedate": "date", "invoicenumber": "string", "netsales": "decimal(18,2)",
    "party_name": "string", "channel": "string", "platform": "string", "saletype": "string",
    "datasource": "string", "rto": "decimal(18,2)", "subchannel": "string",
    "demandchannel": "string", "financepartyname": "string",
}
# SKU of an unmapped product, tax divisor of gross prices, D2C split labels.
UNMAPPED = "Unmapped"
TAX_DIVISOR = "1.18"
CORE_LABEL, NON_CORE_LABEL = "D2C Core", "D2C Non-Core"


@dataclass(frozen=True)
class Marketplace:
    """Constants and rules of one marketplace report."""

    party_name: str
    platform: str
    datasource: str
    subchannel: str
    demandchannel: str
    financepartyname: str
    channel: str = "ECOM"
    sale_types: Mapping[str, str] = field(default_factory=dict)
    negative_types: Sequence[str] = ()
    drop_types: Sequence[str] = ()


def _sales(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    none = F.lit(None)
    return df.select(
        *[columns.get(c, none).cast(kind).alias(c) for c, kind in SALES_COLUMNS.items()]
    )


def first_active_listing(listings: DataFrame) -> DataFrame:
    """The oldest active listing per platform code."""
    active = listings.where("isactive")
    oldest = one_per_key(active, ["platformcode"], [*null_high("createdat"), "id"], "first")
    return oldest.select("platformcode", "ipcode")


def sku_by_code(listings: DataFrame, products: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Platform code (and further keys) to warehouse SKU: the two lookup tables joined up front,
    so that the sales are joined once. Both grow with the assortment, and texts built from a
    narrow column are many times its size in a file: the hint keeps them off the driver."""
    skus = products.select("ipcode", "whsku").hint("merge")
    return listings.join(skus, "ipcode", "left").select(*keys, "whsku")


Named = Callable[[str], Column]


def marketplace_kept(c: Named, rules: Marketplace) -> Column:
    return ~c("event").isin(list(rules.drop_types)) if rules.drop_types else F.lit(True)


def marketplace_columns(c: Named, rules: Marketplace) -> dict[str, Column]:
    """Sales columns of typed events (code, event, quantity, order, date, invoice, amount) and the
    SKU looked up for the code."""
    event = c("event")
    sku = F.coalesce("whsku", F.lit(UNMAPPED))
    saletype = reduce(
        lambda x, kv: x.when(event == kv[0], kv[1]), rules.sale_types.items(), F.when(F.lit(False), "")
    )
    negative = event.isin(list(rules.negative_types)) if rules.negative_types else F.lit(False)
    return {
        "product_code": c("code"),
        "whsku": sku,
        "whsku_key": F.upper(sku),
        "quantity": F.when(negative, -c("quantity")).otherwise(c("quantity")),
        "externalordernumber": c("order_id"),
        "invoicedate": c("invoice_date"),
        "invoicenumber": c("invoice_id"),
        "netsales": c("amount"),
        "saletype": saletype,
        "rto": F.when(saletype == "RTO", c("amount")).otherwise(F.lit(0)),
        **_constants(rules),
    }


def marketplace_sales(sales: DataFrame, skus: DataFrame, rules: Marketplace) -> DataFrame:
    """Sales with typed events: (code, event, quantity, order, date, invoice, amount)."""
    kept = sales.where(marketplace_kept(F.col, rules))
    mapped = lookup_join(kept, skus.withColumnRenamed("platformcode", "code"), ["code"])
    return _sales(mapped, marketplace_columns(F.col, rules))


def _constants(rules: Marketplace) -> dict[str, Column]:
    names = ["party_name", "channel", "platform", "datasource", "subchannel", "demandchannel",
             "financepartyname"]
    return {n: F.lit(getattr(rules, n)) for n in names}


def gross_price_columns(c: Named, rules: Marketplace) -> dict[str, Column]:
    """One unit per row at a tax-inclusive price."""
    sku = F.coalesce("whsku", F.lit(UNMAPPED))
    return {
        "product_code": c("code"),
        "whsku": sku,
        "whsku_key": F.upper(sku),
        "quantity": F.lit(1),
        "externalordernumber": c("order_id"),
        "invoicedate": c("invoice_date"),
        "netsales": F.round(c("amount") / F.lit(TAX_DIVISOR).cast("decimal(3,2)"), 2),
        "saletype": F.lit("Sale"),
        "rto": F.lit(0),
        **_constants(rules),
    }


def skus_of_models(
    listings: DataFrame, products: DataFrame, channel_of_model: Mapping[str, int]
) -> DataFrame:
    """``code, business_model, whsku`` of active listings.

    "model A and channel 1, or model B and channel 2" is one equality once the listing carries
    the model of its channel.
    """
    pairs = [F.when(F.col("channelid") == ch, model) for model, ch in channel_of_model.items()]
    of_model = listings.where("isactive").withColumn("business_model", F.coalesce(*pairs))
    return sku_by_code(of_model.withColumnRenamed("platformcode", "code"), products, ["code", "business_model"])


def gross_price_sales(
    sales: DataFrame,
    listings: DataFrame,
    products: DataFrame,
    channel_of_model: Mapping[str, int],
    rules: Marketplace,
) -> DataFrame:
    """One unit per row at a tax-inclusive price; the business model picks the listing's channel."""
    kept = sales.where(~F.col("order_status").isin(list(rules.drop_types)))
    skus = skus_of_models(listings, products, channel_of_model)
    return _sales(lookup_join(kept, skus, ["code", "business_model"]), gross_price_columns(F.col, rules))


def first_marketing_type(order_lines: DataFrame) -> DataFrame:
    """The marketing type of each order's newest line."""
    named = order_lines.where(F.col("ordername").isNotNull())
    newest = one_per_key(
        named.select("ordername", "marketingtype", "updated_at"),
        ["ordername"],
        null_high("updated_at", "marketingtype"),
        "last",
    )
    return newest.select("ordername", "marketingtype")


def warehouse_columns(c: Named, datasource: str, returns: bool = False) -> dict[str, Column]:
    """Warehouse sales, or returns with quantity and value negated; D2C splits by the marketing
    type looked up for the order."""
    sign = F.lit(-1 if returns else 1)
    value = c("netsale") * sign
    d2c = c("channel") == "D2C"
    finance = (
        F.when(d2c & (F.col("marketingtype") == "CORE"), CORE_LABEL)
        .when(d2c, NON_CORE_LABEL)
        .otherwise(c("financepartyname"))
    )
    plain = ["whsku", "externalordernumber", "invoicedate", "invoicenumber", "channel", "platform",
             "saletype", "subchannel", "demandchannel"]
    return {
        **{n: c(n) for n in plain},
        "whsku_key": F.upper(c("whsku")),
        "quantity": c("qty") * sign,
        **({} if returns else {"orderid": c("orderid")}),
        "netsales": value,
        "party_name": c("partyname"),
        "datasource": F.lit(datasource),
        "rto": F.when(c("saletype") == "RTO", value).otherwise(F.lit(0)),
        "financepartyname": finance,
    }


def warehouse_sales(
    rows: DataFrame,
    types: DataFrame,
    datasource: str,
    excluded_locations: Sequence[str],
    returns: bool = False,
) -> DataFrame:
    """Warehouse sales, or returns with quantity and value negated; D2C splits by order type."""
    kept = rows.where(~F.col("location").isin(list(excluded_locations)))
    typed = lookup_join(
        kept, types.withColumnRenamed("ordername", "externalordernumber"), ["externalordernumber"]
    )
    return _sales(typed, warehouse_columns(F.col, datasource, returns))


def ledger_columns(c: Named, datasource: str) -> dict[str, Column]:
    plain = ["whsku", "quantity", "party_name", "channel", "platform", "saletype"]
    return {
        **{n: c(n) for n in plain},
        "whsku_key": F.upper(c("whsku")),
        "invoicedate": c("date"),
        "invoicenumber": c("voucher_number"),
        "netsales": c("amount"),
        "datasource": F.lit(datasource),
        "rto": F.when(c("saletype") == "RTO", c("amount")).otherwise(F.lit(0)),
        "subchannel": F.lit(""),
        "demandchannel": F.lit(""),
        "financepartyname": c("party_name"),
    }


def ledger_sales(rows: DataFrame, datasource: str) -> DataFrame:
    return _sales(rows, ledger_columns(F.col, datasource))


@dataclass(frozen=True)
class Branch:
    """One report among several in a table: its rows, its columns as SQL over the table's, the
    rows to keep, the lookup (``source``) and its code, and the sales columns. The last three are
    told through a function that gives the report's columns."""

    where: str
    reads: Sequence[str]
    keep: Callable[[Named], Column]
    source: str | None
    code: Callable[[Named], Column]
    columns: Callable[[Named], Mapping[str, Column]]


def fan_out(rows: DataFrame, branches: Sequence[Branch], lookups: DataFrame) -> DataFrame:
    """Sales of all branches from one scan: each row is tagged with the first branch whose rows it
    belongs to, and one lookup keyed by (source, code) maps all of them.

    ``lookups`` has ``source, code, whsku, marketingtype``. Rows of no branch are left out; a row
    whose code is not listed, or NULL, keeps NULLs; a code listed twice gives two rows.
    """
    tag = reduce(lambda x, i: x.when(F.expr(branches[i].where), i), range(len(branches)), F.when(F.lit(False), -1))
    report = lambda i: F.struct(*[F.expr(e) for e in branches[i].reads])
    tagged = rows.withColumn("_tag", tag).where("_tag IS NOT NULL")
    tagged = tagged.select("_tag", *[F.when(F.col("_tag") == i, report(i)).alias(f"_b{i}") for i in range(len(branches))])
    named = [lambda n, i=i: F.col(f"_b{i}.{n}") for i in range(len(branches))]

    def chosen(of: Callable[[int], Column | None]) -> Column:
        out = F.when(F.lit(False), None)
        for i in range(len(branches)):
            value = of(i)
            if value is not None:
                out = out.when(F.col("_tag") == i, value)
        return out

    kept = tagged.where(chosen(lambda i: branches[i].keep(named[i])))
    kept = kept.withColumn("source", chosen(lambda i: F.lit(branches[i].source).cast("string")))
    kept = kept.withColumn("code", chosen(lambda i: branches[i].code(named[i]) if branches[i].source else None))
    mapped = lookup_join(kept, lookups, ["source", "code"])
    columns = [b.columns(n) for b, n in zip(branches, named)]
    return mapped.select(
        *[
            chosen(lambda i: columns[i][c].cast(kind) if c in columns[i] else None).cast(kind).alias(c)
            for c, kind in SALES_COLUMNS.items()
        ]
    )


def costed_branches(
    branches: Sequence[DataFrame], costs: DataFrame, slot: str = "year"
) -> list[DataFrame]:
    """Each branch with price and cost of the nearest cost snapshot. Snapshots are months apart, so
    a slot of a year repeats few intervals for each of the branches."""
    keyed = costs.withColumn("whsku_key", F.upper("whsku")).drop("whsku")
    costed = join_nearest_snapshots(
        branches, keyed, ["whsku_key"], "invoicedate", "valuationdate", "updatedat", ["mrp", "cogs"],
        slot=slot,
    )
    return [branch.drop("whsku_key") for branch in costed]


def primary_sales(branches: Sequence[DataFrame], costs: DataFrame) -> DataFrame:
    """All branches (from tables of their own, or fanned out of one) as one table, with price and
    cost of the nearest cost snapshot."""
    return costed_branches([reduce(DataFrame.unionByName, branches)], costs, "month")[0]


# --- agents ---------------------------------------------------------------------------------


def agent_map(agents: DataFrame, teams: Mapping[str, str]) -> DataFrame:
    """Agents whose e-mail contains one of the texts, with that text's team."""
    email = F.get_json_object("contact", "$.email")
    team = F.coalesce(*[F.when(email.contains(text), name) for text, name in teams.items()])
    named = agents.select(
        F.col("id").alias("agent_id"),
        F.get_json_object("contact", "$.name").alias("agent_name"),
        email.alias("agent_email"),
        team.alias("team_name"),
        team.alias("support_type"),
    )
    return named.where(F.col("team_name").isNotNull())


def agent_ranking(ranking: DataFrame) -> DataFrame:
    """Display form of the monthly ranking: shares as percent, newest month and best rank first."""
    shares = ["resolution_pct", "fcr_pct", "csat_pct"]
    shown = ranking.withColumns({f"{c}_display": F.round(F.col(c) * 100, 2) for c in shares})
    shown = shown.withColumnRenamed("frt_display", "first_response_time").drop(*shares)
    return shown.orderBy(F.desc_nulls_first("month_year"), F.asc_nulls_last("final_rank"))


# --- inventory ------------------------------------------------------------------------------

# The bucket that bin detail replaces, and the bin that has a bucket of its own.
IN_PROCESS, STAGE_BIN, STAGE_BUCKET = "In Process", "stagebin", "Stage bin"


def bin_detail(bins: DataFrame) -> DataFrame:
    """Bin quantities summed per SKU, location and bucket."""
    code = F.lower(F.trim("bincode"))
    bucket = F.when(code == STAGE_BIN, STAGE_BUCKET).otherwise(IN_PROCESS)
    return bins.groupBy("skucode", "location", bucket.alias("bucket")).agg(
        F.sum("quantity").alias("quantity")
    )


def inventory(
    raw: DataFrame, bins: DataFrame | None, seq: Sequence[str], updated_on: Column
) -> DataFrame:
    """Last row per SKU, location and bucket; "In Process" rows replaced by bin detail, or kept
    when there is none (or it is empty)."""
    last = keep_last(raw, ["skucode", "location", "bucket"], seq)
    stock = last.select("skucode", "location", "bucket", "quantity")
    if bins is not None and not bins.isEmpty():
        stock = replace_slice(stock, F.col("bucket") == IN_PROCESS, bin_detail(bins))
    return stock.withColumn("updated_on", updated_on)
