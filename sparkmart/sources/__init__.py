"""Sources, sinks and their control tables."""

from .extract import extract_all, extract_entity  # noqa: F401
from .jdbc import jdbc_options, read_jdbc_tables  # noqa: F401
from .pages import (  # noqa: F401
    infer_arrival_schema, read_page_stream, read_pages, rows_of, unwrap_pages,
)
from .schemas import ENTITIES, RAW_SCHEMAS  # noqa: F401
from .tables import (  # noqa: F401
    append_batch, materialize, read_batches, sources, write_table,
)
from .watermark import (  # noqa: F401
    advance_watermark, filter_updated_after, read_watermark, save_watermark,
)
