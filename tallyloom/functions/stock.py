"""Stock code classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .text import strip_space


def _key(code: Column) -> Column:
    return F.upper(strip_space(code))


def is_product(code: Column) -> Column:
    """Whether a code is a product code. Those begin with a digit, as no other listed code does."""
    return _key(code).rlike(fv.PRODUCT_CODE_PATTERN)


def stock_category(code: Column) -> Column:
    """Class of a stock code; case and outer white space are ignored."""
    key = _key(code)
    lists, prefixes = fv.STOCK_CODE_LISTS, fv.STOCK_CODE_PREFIXES
    expr = F.when(is_product(code), fv.PRODUCT_LIKE)
    for category in [*lists, *prefixes]:
        if category in lists:
            expr = expr.when(key.isin(lists[category]), category)
        if category in prefixes:
            expr = expr.when(key.startswith(prefixes[category]), category)
    return expr.otherwise(fv.OTHER_CODE)
