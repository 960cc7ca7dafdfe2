"""Relational operators, DataFrame in and DataFrame out."""

from .aggregate import group_sum_count  # noqa: F401
from .calendar import date_spine, date_spine_over  # noqa: F401
from .dedup import dedup_latest, filter_positive  # noqa: F401
from .hot import hot_keys  # noqa: F401
from .lookup import lookup, lookup_current  # noqa: F401
from .merge import merge_by_key, upsert_by_key  # noqa: F401
from .quality import (  # noqa: F401
    Check, check_not_null, check_relationships, check_unique, multiset_digest, quality_report,
)
from .scd2 import scd2_apply, scd2_from_log, scd2_step  # noqa: F401
from .schema import conform_columns, serialize_nested, snake_case_columns  # noqa: F401
