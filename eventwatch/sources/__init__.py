"""Sources: message streams and files, lookup tables, the driver-data adapter."""
