"""Log sources: building logs from tables, scans, discovery, seeks on written logs."""
