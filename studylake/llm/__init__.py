"""Training-data operators: near-dedup, packing, sharding, mixing, scans,
classifiers and quality rules, each a DataFrame -> DataFrame function."""
