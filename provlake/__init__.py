"""provlake: a PySpark-native engine for versioned-document provenance."""
