"""Zone tables, reports and the medallion run."""
