"""Column expressions. Everything here runs inside Spark's generated code; there are no UDFs."""
