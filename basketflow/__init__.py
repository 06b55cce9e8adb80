"""Commerce behaviour analytics expressed as plain DataFrame functions.

``functions``  column expressions (metrics, text cleaning, hashing)
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers and writers
``streaming``  Structured Streaming queries over the same operators
``plans``      end-to-end jobs, serving queries and the query catalog
"""
