"""Every operator bound to the driver's tables, next to the SQL that must give the same rows."""
