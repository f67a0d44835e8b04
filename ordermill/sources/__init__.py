"""Readers: the star-schema input shaped into raw tables, and run-date partitions."""
