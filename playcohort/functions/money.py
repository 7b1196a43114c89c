"""Amounts are decimal yuan inside and whole cents in reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from playcohort import constants as C

MONEY = DecimalType(18, 2)


def zero_if_null(amount: Column) -> Column:
    return F.coalesce(amount.try_cast(MONEY), F.lit(0).cast(MONEY))


def gross_amount(ori_price: Column, total_amt: Column) -> Column:
    return (zero_if_null(ori_price) + zero_if_null(total_amt)).cast(MONEY)


def signed(amount: Column, status: Column) -> Column:
    """Paid orders add, everything else kept by the status filter (refunds) subtracts."""
    return F.when(status == C.PAID, amount).otherwise(-amount)


def cents(amount: Column) -> Column:
    return (amount * 100).cast("long")


def pay_type_code(payment_type: Column) -> Column:
    """One-character code of a payment type, 0 when nothing was paid."""
    code = F.coalesce(payment_type, F.lit(0)).cast("string")
    for number, letter in C.PAY_TYPE_CODES.items():
        code = F.when(payment_type == number, F.lit(letter)).otherwise(code)
    return code


def arpu(amount: Column, accounts: Column) -> Column:
    return F.when(accounts == 0, F.lit(0)).otherwise(amount / accounts)


def percent_to_int(percent_times_100: Column) -> Column:
    """Integer percent from a value in hundredths of a percent."""
    return F.floor(percent_times_100 / 100).cast("int")
