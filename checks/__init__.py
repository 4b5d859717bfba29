"""Independent checks: DuckDB SQL oracles for the named queries."""
