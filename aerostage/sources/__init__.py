"""Readers for landed payloads, driver-table adapters, request plan and coverage."""
