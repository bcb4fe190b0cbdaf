"""Inputs (driver tables, derived click-log views, stream source) and sinks."""
