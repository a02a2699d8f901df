"""Reading, writing and staging tables; stream sources; test-data views."""
