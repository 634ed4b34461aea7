"""Order-independent sums of money.

Adding doubles gives different last digits for every partitioning. Amounts are
therefore turned into whole millionths, added as decimals, and turned back into
a double once. A row's amount is rounded to millionths before it is added, so
half a millionth per row is the most that can be lost. Amounts that do not fit
(beyond about 9e12, NaN, infinity) are added as doubles next to it, so nothing is
left out; the last digits of such sums may depend on the order of rows.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1e6


def micros(amount: Column) -> Column:
    """Amount in whole millionths, null when it does not fit a bigint."""
    return F.rint(amount * F.lit(MICROS)).try_cast("bigint").cast("decimal(19,0)")


def overflow(amount: Column) -> Column:
    """The amount when ``micros`` cannot hold it, else null."""
    return F.when(micros(amount).isNull(), amount)


def to_amount(micro_sum: Column, overflow_sum: Column) -> Column:
    """Combine the two partial sums; null only if there was nothing to add."""
    whole = micro_sum.cast("double") / F.lit(MICROS)
    return F.when(
        micro_sum.isNotNull() | overflow_sum.isNotNull(),
        F.coalesce(whole, F.lit(0.0)) + F.coalesce(overflow_sum, F.lit(0.0)),
    )


def exact_sum(amount: Column) -> Column:
    """``sum(amount)`` as a double that does not depend on row order."""
    return to_amount(F.sum(micros(amount)), F.sum(overflow(amount)))

