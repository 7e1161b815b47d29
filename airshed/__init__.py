"""Spark jobs for environmental-observation data: landing, cleaning, quality reports, daily marts."""
