"""Brazilian registration numbers and postal codes.

The rules are the public ones: modulo-11 check digits, full length, and no number made of one
repeated digit. Everything is a native expression over the whole column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.text import ColumnOrName, as_column

# The weights of the first and second check digit.
CPF_WEIGHTS = ([10, 9, 8, 7, 6, 5, 4, 3, 2], [11, 10, 9, 8, 7, 6, 5, 4, 3, 2])
CNPJ_WEIGHTS = ([5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2], [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2])


def digits_of(c: ColumnOrName) -> Column:
    return F.regexp_replace(as_column(c), "[^0-9]", "")


def _check_digit(number: Column, weights: list[int]) -> Column:
    total = F.lit(0)
    for at, weight in enumerate(weights, start=1):
        total = total + (F.ascii(F.substring(number, at, 1)) - F.lit(48)) * F.lit(weight)
    return (F.lit(11) - total % 11) % 11 % 10


def _valid(number: Column, weights: tuple[list[int], list[int]]) -> Column:
    body = len(weights[0])
    tail = F.concat(
        _check_digit(number, weights[0]).cast("string"), _check_digit(number, weights[1]).cast("string")
    )
    shape = (F.length(number) == body + 2) & ~number.rlike(r"^(\d)\1*$")
    return F.when(shape, F.substring(number, body + 1, 2) == tail).otherwise(
        F.when(number.isNotNull(), F.lit(False))
    )


def cpf_is_valid(c: ColumnOrName, clean: bool = False) -> Column:
    """Person number: 11 digits with two check digits. NULL stays NULL.

    Pass ``clean=True`` for a column that holds digits only; the expression is much smaller then.
    """
    return _valid(as_column(c) if clean else digits_of(c), CPF_WEIGHTS)


def cnpj_is_valid(c: ColumnOrName, clean: bool = False) -> Column:
    """Company number: 14 digits with two check digits. NULL stays NULL."""
    return _valid(as_column(c) if clean else digits_of(c), CNPJ_WEIGHTS)


def normalize_cep(c: ColumnOrName) -> Column:
    """Postal code as eight digits, else NULL."""
    number = digits_of(c)
    return F.when(F.length(number) == 8, number)
