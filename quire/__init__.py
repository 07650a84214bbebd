"""quire: literature-feed analytics as Spark DataFrame and Structured Streaming jobs.

Layout
------
functions/  Column -> Column scalar expressions (normalisation, JSON repair, links)
sources/    table loaders, tolerant scans, partition discovery, page extraction
operators/  DataFrame -> DataFrame operators (matching, dedup, trends, digest, ...)
plans/      composite jobs (search request, reading list, keyword statistics,
            daily pipeline) and the registry of checked queries
streaming/  Structured Streaming counterparts (incremental ingest, look-back dedup,
            daily counts, per-batch publish)
"""

__version__ = "0.1.0"
