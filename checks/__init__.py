"""The operators bound to the driver's tables, with the SQL each result is compared to."""
