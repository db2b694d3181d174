"""Product indicators as column expressions (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stock level and margin limits of the two indicators.
STOCK_LIMIT = 1500
DEMAND_MARGIN = 50
PROMOTION_MARGIN = 20

MONEY = "decimal(10,2)"


def product_kpis(buy_price: Column, msrp: Column, stock: Column) -> Column:
    """Struct of profit, profitpercent, promoind and demandind.

    The limits are compared with the unrounded margin. A NULL input, or a buy
    price of zero, leaves what depends on it NULL instead of failing the job.
    """
    profit = msrp.cast(MONEY) - buy_price.cast(MONEY)
    margin = F.try_divide(profit, buy_price.cast(MONEY)) * 100
    known = margin.isNotNull() & stock.isNotNull()
    promote = (stock > STOCK_LIMIT) & (margin > PROMOTION_MARGIN)
    demand = (stock > 0) & (stock < STOCK_LIMIT) & (margin > DEMAND_MARGIN)
    return F.struct(
        profit.try_cast(MONEY).alias("profit"),
        margin.try_cast(MONEY).alias("profitpercent"),
        F.when(known, promote.cast("smallint")).alias("promoind"),
        F.when(known, demand.cast("smallint")).alias("demandind"),
    )


def with_product_kpis(products: DataFrame, buy_price="buyprice", msrp="msrp", stock="quantityinstock") -> DataFrame:
    kpis = product_kpis(F.col(buy_price), F.col(msrp), F.col(stock))
    return products.withColumn("_kpis", kpis).select(*products.columns, "_kpis.*")
