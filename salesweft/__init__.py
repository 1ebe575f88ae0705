"""Retail order analytics as Spark DataFrame operators.

Layers, lowest first:

* ``functions``  column expressions (no DataFrame needed)
* ``sources``    readers, writers, schemas, the star-schema mapping
* ``operators``  DataFrame -> DataFrame building blocks
* ``plans``      whole analyses composed from the operators
* ``streaming``  Structured Streaming forms of ingest and roll-up
"""
