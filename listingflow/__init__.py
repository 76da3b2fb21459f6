"""Listing analytics as Spark DataFrame operators.

``functions``  column expressions (no shuffle, whole-stage codegen)
``sources``    scans and sinks
``operators``  DataFrame(s) + config -> DataFrame
``plans``      the composed runs: build, replay, search pass
"""
