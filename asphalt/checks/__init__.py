"""Every operator run on the test tables, with the same question put to DuckDB."""
