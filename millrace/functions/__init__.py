"""Column builders: everything here compiles to built-in Spark expressions."""
