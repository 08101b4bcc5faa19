"""Table movement and SQLite semantics as Spark DataFrame operators."""
