"""Column functions; none of them starts a job."""
