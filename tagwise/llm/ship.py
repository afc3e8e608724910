"""Broadcasts of objects whose classes live in this package: executors don't
have it on their path, so the object travels as bytes pickled by value."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import SparkSession


class Shipped:
    def __init__(self, spark: SparkSession, obj):
        self.bytes = spark.sparkContext.broadcast(cloudpickle.dumps(obj))

    def get(self):
        return cloudpickle.loads(self.bytes.value)
