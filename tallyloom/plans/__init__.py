"""Reports, the table store and the load job."""
