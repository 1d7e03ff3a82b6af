"""Insider-filing analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column`` under
``functions``): it only declares a plan, so Catalyst sees one query from scan to sink.
"""
