"""Sources: CSV scans of the raw zone, landing, probes, driver-table adapters."""
