"""Readers and writers: driver Parquet adapters, CSV files, model and result stores."""
