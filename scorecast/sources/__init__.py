"""Sources (table resolvers, test-data binding) and sinks (report writers)."""

from .catalog import BindingCatalog, Catalog, JdbcCatalog, MemoryCatalog, ParquetCatalog  # noqa: F401
