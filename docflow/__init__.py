"""Documents to tables on PySpark: land, extract, normalize, check, report, search."""
