"""parcelflow: a Spark-native cadastral layer pipeline.

Layers are enriched with vintage, département, commune and object type,
stacked into one canonical 23-column dataset, routed into export batches
and written sorted; users extract by code or by extent.  Planning of
downloads, file inventories, link crawling and shapefile/archive ingest
are Spark jobs too.
"""

__version__ = "0.1.0"
