"""Jobs made of several operators, and the registered queries."""
