"""creatorlens: influencer-marketing analytics expressed as Spark DataFrame plans.

Sub-packages
------------
``sources``    readers and sinks (CSV / text / JSON / parquet)
``functions``  Column-expression builders (text cleaning, JSON extraction, vector math)
``operators``  DataFrame -> DataFrame operators (features, lexicons, sentiment,
               catalog, ranking, evaluation, TF-IDF, clustering, classification)
``plans``      compositions of operators over the driver's test tables
``streaming``  the engagement feature as an incremental Structured Streaming job
"""

__version__ = "0.1.0"
