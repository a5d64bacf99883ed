"""DataFrame operators: tables and column names in, a table out."""
