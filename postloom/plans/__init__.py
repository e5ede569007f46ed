"""Plan shapes shared by operators: spread lookups and two-level ordered scans."""
