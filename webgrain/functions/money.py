"""Deposit formulas. Amounts are rounded half up to cents by Spark's ``round``."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_deposit(principal: Column, rate: Column, years: Column) -> Column:
    """Yearly compound interest."""
    return F.round(principal * F.pow(1 + rate / 100, years), 2)


def recurring_deposit(principal: Column, rate: Column, years: Column) -> Column:
    """Monthly payments, quarterly interest; null for rate 0."""
    quarterly = 1 + rate / 400
    grown = F.pow(quarterly, years * 4) - 1
    paid = 1 - F.pow(quarterly, F.lit(-1.0 / 3.0))
    return F.round(principal * F.try_divide(grown, paid), 2)


def deposit_ladder(principal: Column, rate: Column, years: Column, premium: Column) -> Column:
    """Sum of one deposit per premium year, each running to the end."""
    steps = F.when(premium > 0, F.sequence(F.lit(0), premium - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(
        steps, F.lit(0.0), lambda acc, i: acc + fixed_deposit(principal, rate, years - i)
    )


def rd_then_fd(principal: Column, rate: Column, years: Column, premium: Column) -> Column:
    """Recurring deposit for the premium years, then a fixed deposit for the rest."""
    return fixed_deposit(recurring_deposit(principal, rate, premium), rate, years - premium)


def maturity(principal, rate, years, premium, is_fixed: Column) -> Column:
    return F.when(is_fixed, deposit_ladder(principal, rate, years, premium)).otherwise(
        rd_then_fd(principal, rate, years, premium)
    )


def lakhs(amount: Column) -> Column:
    """Whole units of 100,000, truncated."""
    return (amount / 100000).cast("int")
