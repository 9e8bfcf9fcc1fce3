"""Wellness and performance analytics as PySpark DataFrame operators.

Layout: ``functions`` holds column expressions, ``operators`` DataFrame to
DataFrame steps, ``sources`` scans and sinks, ``plans`` whole jobs, and
``streaming`` the Structured Streaming forms of the same operators.
"""
