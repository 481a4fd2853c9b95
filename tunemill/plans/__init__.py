"""Named queries (catalog), their SQL oracle (sql, oracle) and the whole flow."""
