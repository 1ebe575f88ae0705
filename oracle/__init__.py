"""DuckDB SQL that gives the same results as the registered queries."""
