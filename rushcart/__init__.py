"""Analytics for online shops under heavy traffic, as plain DataFrame functions.

Sessions are expected to run with ``spark.sql.session.timeZone=UTC``.
"""
