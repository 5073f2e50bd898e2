"""nimbra: hourly sensor readings to daily summaries, extreme days and reports on Spark.

Layers: Bronze (nested JSON documents) -> Silver (typed hourly rows) -> Gold
(daily summary per city, extreme events) -> reports and quality gates. Every
operator is a function from DataFrame to DataFrame.
"""
