"""Training-data operators: packing, filtering, de-duplication, scoring, extraction, sharding."""
