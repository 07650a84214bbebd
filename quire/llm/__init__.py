"""Operators of a training-data pipeline (quality, fingerprints, licences,
packing, similarity joins, line and passage dedup, sharding, decontamination,
HTML extraction).  Nothing else in the library imports this subpackage."""
