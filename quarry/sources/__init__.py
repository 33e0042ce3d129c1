from .tables import SCHEMAS, TABLE_NAMES, Tables, load_table, tables

__all__ = ["SCHEMAS", "TABLE_NAMES", "Tables", "load_table", "tables"]
