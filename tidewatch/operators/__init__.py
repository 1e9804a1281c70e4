"""Reusable DataFrame -> DataFrame operators. All are lazy but build_crosswalk, which stores each tier."""
