"""Jobs made of the operators, quality checks, and the queries over the driver's tables."""
