"""hhlens: household microdata analytics on Spark.

Two-level survey microdata (households and their persons) is rolled up, profiled,
described, resampled, modelled and evaluated with DataFrame / SQL / Spark ML jobs.

Sub-packages
------------
sources    readers, writers, prediction sink, literal dimension tables, adapter views
functions  column expressions: recodes, flags, guards, dummies, portable randomness
operators  distributed operators: rollup, profile, describe, sampling, evaluate, models
plans      the survey-specific feature catalogue and the end-to-end pipelines
streaming  incremental scoring of arriving household files with a fitted model
"""

__version__ = "0.1.0"
