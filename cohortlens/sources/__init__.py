"""Sources and sinks: declared schemas, the driver-table adapter, CSV
readers, column defaults, constraint audit, materialisation and writers."""

from cohortlens.sources.driver import AS_OF, customers, driver_tables, transactions
from cohortlens.sources.schemas import SCHEMAS, schema_for

__all__ = ["AS_OF", "SCHEMAS", "customers", "driver_tables", "schema_for", "transactions"]
