"""quillgrid: a PySpark-native engine for signal ingestion and analytics."""
