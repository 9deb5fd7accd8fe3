"""Every operator as a query over the given tables, next to the SQL that must agree with it."""
