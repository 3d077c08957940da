"""The same results in DuckDB SQL, for comparison."""
