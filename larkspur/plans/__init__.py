"""Write plans: partitioned archives, table layouts, lookup acceleration."""
