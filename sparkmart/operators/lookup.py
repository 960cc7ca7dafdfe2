"""Left joins of a fact to a lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import is_current

from .hot import TASK_ROWS, hot_keys, is_hot

_KEY, _SALT = "_lookup_key", "_lookup_salt"


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: str | tuple[str, str],
    take: Sequence[str] | Mapping[str, str],
    salt: int | str = 1,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Left join that keeps every fact row and adds the ``take`` columns of ``dim``.

    ``on`` is one shared name or (fact column, dim column); ``take`` is a list of
    names or {dim column: new name}.  The join strategy is left to Spark: a side under
    the broadcast threshold is broadcast, also when its size is known only at run
    time, and hot keys of a shuffled join are split by adaptive execution.

    ``salt > 1`` splits every fact key into that many groups and copies the lookup as
    often, for clusters where adaptive execution is off.  The salt is the number of
    the fact's partition, so a re-run task gives its rows the same salt again.
    ``salt='hot'`` does so for the keys alone that hold more than ``task_rows`` fact rows, NULL
    included: a sketch of the fact's key finds them, all other keys are joined as they are and the
    lookup's rows of hot keys are the only ones copied.
    """
    left_key, right_key = (on, on) if isinstance(on, str) else on
    names = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    right = dim.select(F.col(right_key).alias(_KEY), *[F.col(c).alias(n) for c, n in names.items()])
    condition = F.col(left_key) == F.col(_KEY)
    if salt == "hot":
        hot = hot_keys(fact, left_key, task_rows)
        many = max(hot.values(), default=1)
        if many > 1:
            own = F.when(is_hot(F.col(left_key), hot), F.pmod(F.spark_partition_id(), F.lit(many))).otherwise(F.lit(0))
            copies = F.when(is_hot(F.col(_KEY), hot), F.sequence(F.lit(0), F.lit(many - 1))).otherwise(F.array(F.lit(0)))
            fact, right = fact.withColumn(_SALT, own), right.withColumn(f"{_SALT}_r", F.explode(copies))
            condition = condition & (F.col(_SALT) == F.col(f"{_SALT}_r"))
    elif salt > 1:
        fact = fact.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(salt)))
        right = right.withColumn(f"{_SALT}_r", F.explode(F.array(*[F.lit(i) for i in range(salt)])))
        condition = condition & (F.col(_SALT) == F.col(f"{_SALT}_r"))
    return fact.join(right, condition, "left").drop(_KEY, _SALT, f"{_SALT}_r")


def lookup_current(
    fact: DataFrame,
    dim: DataFrame,
    on: str | tuple[str, str],
    take: Sequence[str] | Mapping[str, str],
    valid_to: str = "valid_to",
    salt: int | str = 1,
) -> DataFrame:
    """Lookup in the open versions of a versioned dimension; closed ones never match.

    The filter is on ``valid_to`` itself, which Parquet can push into its scan.
    """
    return lookup(fact, dim.filter(is_current(valid_to)), on, take, salt)
