from meterwise.sources.fixtures import sources, src_billing, src_customers, src_sessions  # noqa: F401
from meterwise.sources.io import (export_csv, import_csv, land, read_landed, read_source,  # noqa: F401
                                  read_source_jdbc)
