"""Retail analytics on Spark: change logs, clickstream and catalog snapshots to a star schema and marts."""
