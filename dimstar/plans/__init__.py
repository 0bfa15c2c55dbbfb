"""Reports over the star schema, the load plan, and the registered queries."""
