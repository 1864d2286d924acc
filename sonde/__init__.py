"""sonde: a PySpark-native engine for clinical-record text, signals and evaluation tables."""
