"""Road-sensor analytics as plain PySpark transforms, batch and streaming."""
