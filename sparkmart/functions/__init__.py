"""Column builders.  All of them stay inside the JVM and inside code generation."""

from .casts import (  # noqa: F401
    cast_bool, cast_date, cast_int, cast_money, cast_pct, cast_text, cast_to, cast_ts,
)
from .dates import (  # noqa: F401
    date_key, date_parts, day_name, hours_between, is_weekend, iso_week, to_day, utc_ntz,
)
from .measures import gross_revenue, is_current, ratio  # noqa: F401
from .text import clean_phone, coalesce_empty, full_name, md5_key, pack_key, surrogate_key, unpack_key  # noqa: F401
from .types import struct  # noqa: F401
