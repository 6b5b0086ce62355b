"""Position-telemetry analytics as DataFrame -> DataFrame operators for Spark.

``functions``   column-level rules (identifiers, ranges, times, grid cells, variant coercion)
``operators``   normalise, parse, de-duplicate, aggregate, merge, view
``sources``     streams, snapshots, JDBC tables and the sinks that fill them
``streaming``   micro-batch writers and the wiring of the running queries
``plans``       the registered queries over the shared test tables, with their SQL oracles
"""
