"""Palisade: security-log analytics and training-data preparation on PySpark.

Sub-packages
------------
``functions``  scalar functions (protocol numbers, OCSF names, flow hash)
``sources``    readers, explicit schemas and log synthesizers
``operators``  DataFrame operators: parsers, normalizers, detections and the
               general data-preparation operators
``streaming``  file-stream runner and sinks
``plans``      the query registry and its SQL counterparts
``llm``        operators for training text; optional, nothing else imports it
"""

__version__ = "0.1.0"
