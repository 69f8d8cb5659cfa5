"""Row rules and type handling as Spark column expressions."""
