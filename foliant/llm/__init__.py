"""Training-data operators: deduplication, scoring, mixing, filtering, formatting, packing and extraction on Spark."""
