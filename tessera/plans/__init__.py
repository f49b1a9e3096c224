"""Registered analyses over the driver tables: the Spark plan and its SQL twin."""
