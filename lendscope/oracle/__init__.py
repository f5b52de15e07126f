"""The registered queries as DuckDB SQL, written apart from the Spark jobs."""
