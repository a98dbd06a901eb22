"""Column-to-column helpers; nothing here runs a job."""
