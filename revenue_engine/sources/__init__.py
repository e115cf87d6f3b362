"""Scans: landed CSV files, rate payloads, file manifests, job records."""
