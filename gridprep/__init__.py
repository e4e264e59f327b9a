"""PySpark-native preparation of gridded land-surface data."""
