"""Where events go: partitioned files, message tables, exports."""
