"""Readers and writers: games, request files, prediction files, the driver-table testbed."""
