"""Training-data operators: decontamination, scoring, packing, dedup, sharding, archives."""
