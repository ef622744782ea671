"""Order-event medallion build and data-reliability checks on Spark."""
