"""Sources: clinical schemas, readers (Parquet, catalog, JDBC) and the analog tables."""

from clinframe.sources.analog import clinical_tables  # noqa: F401
from clinframe.sources.readers import (  # noqa: F401
    conform, list_tables, preview, read_catalog_tables, read_jdbc_table, read_parquet_tables, run_sql,
    write_bucketed,
)
