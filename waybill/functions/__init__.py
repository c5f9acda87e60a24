"""Column expressions. Everything here is built in and stays in generated code."""
