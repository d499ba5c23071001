"""Column expressions of the reports: valuation, ageing, labels, signs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
AGE_LIMITS = (7, 15, 30, 60, 90, 180, 360)
LED_LOCATIONS = ("RM01", "RM02", "FGR1", "L101", "L109", "L111", "L134", "L135", "PHDT")
LED_PLANTS = ("481A", "482A")
CATEGORY_LED = "1. LED"
CATEGORY_PURCHASING = "2. 策采政備"
CATEGORY_SALES = "3. 業務政備"
CATEGORY_MRP = "4. MRP"
RAW_GROUPS = ("STH", "ST")
BLANK = " "


def present(code: Column) -> Column:
    """Neither NULL nor blank."""
    return F.coalesce(F.trim(code) != "", F.lit(False))


def stock_amount(qty: Column, value: Column, valuated_qty: Column, rate: Column) -> Column:
    """``qty`` at the lot's average price in company currency, 0 without a valuated quantity.

    The casts keep twelve decimals up to the one rounding at the end; without
    them decimal arithmetic would cut the scale on the way.
    """
    per_lot = F.try_divide((qty * value).cast("decimal(27,5)"), valuated_qty).cast("decimal(28,12)")
    amount = F.round(per_lot * rate, 2)
    return F.when(valuated_qty == 0, F.lit(0)).otherwise(amount).cast("decimal(15,2)")


def age_days(date: Column, as_of: datetime) -> Column:
    """Days from ``date`` (YYYYMMDD text) to ``as_of``, rounded half up with the time of day."""
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    fraction = (as_of - midnight).total_seconds() / 86400
    days = F.datediff(F.lit(as_of.date()), F.try_to_date(date, "yyyyMMdd"))
    return F.round(days + F.lit(fraction)).cast("int")


def age_bucket(days: Column) -> Column:
    chain = F.when(days <= AGE_LIMITS[0], f"{AGE_LIMITS[0]:03d}")
    for limit in AGE_LIMITS[1:]:
        chain = chain.when(days <= limit, f"{limit:03d}")
    return chain.otherwise(f"{AGE_LIMITS[-1]}+")


def stock_category(plant: Column, location: Column, group: Column, purchase_order: Column) -> Column:
    led_group = group.startswith("OL")
    return (
        F.when(location.startswith("LD"), CATEGORY_LED)
        .when(plant.isin(*LED_PLANTS) & led_group, CATEGORY_LED)
        .when((plant == "101A") & location.isin(*LED_LOCATIONS) & led_group, CATEGORY_LED)
        .when(purchase_order.startswith("88"), CATEGORY_PURCHASING)
        .when(purchase_order.startswith("87"), CATEGORY_SALES)
        .otherwise(CATEGORY_MRP)
    )


def material_type(group: Column, material_type: Column) -> Column:
    return F.when(group.isin(*RAW_GROUPS), "ZROH").otherwise(material_type)


def _text(*parts: Column) -> Column:
    """Concatenation that skips NULLs instead of becoming NULL."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def document_ref(year: Column, document: Column, item: Column) -> Column:
    return _text(year, F.lit("."), document, F.lit("."), item)


def purchase_ref(order: Column, item: Column) -> Column:
    return F.when(order != BLANK, _text(order, F.lit("."), item)).otherwise(BLANK)


def person_name(first: Column, second: Column) -> Column:
    """Two name parts joined; NULL only when both are."""
    return F.when(first.isNotNull() | second.isNotNull(), _text(first, second))


def resolve_customer(part_customer: Column, default_customer: Column) -> Column:
    return F.coalesce(part_customer, default_customer)


def resolve_owner(acc_rep: Column, ecn_resp: Column, moq_resp: Column) -> Column:
    return F.coalesce(acc_rep, ecn_resp, moq_resp)


def signed(amount: Column, indicator: Column, positive: str) -> Column:
    """``amount`` for the positive debit/credit indicator, negated for any other."""
    return F.when(indicator == positive, amount).otherwise(-amount)


def billed_qty(qty: Column, indicator: Column) -> Column:
    """Billing quantity, negative for a return (indicator X)."""
    return F.when(indicator == "X", -qty).otherwise(qty)


def wip_factor(consumed: Column, output: Column) -> Column:
    """Share of a producer's output that a posting consumes; NULL without an output."""
    return F.try_divide(consumed.cast("double"), output.cast("double"))
