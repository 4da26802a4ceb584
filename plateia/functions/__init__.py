"""Column expressions: text, privacy masks, numbers, times, emotions."""
