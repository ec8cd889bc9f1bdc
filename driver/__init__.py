"""Every operator run on the driver's tables, and the same as DuckDB SQL."""
