"""DataFrame operators and composite jobs for layered analytics on Spark."""
