"""Puts the package where Python workers can import it, whatever the folder that the driver was started in."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to all workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="corpusloom-code-"), "corpusloom_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("corpusloom", os.path.relpath(full, top)))
    sc.addPyFile(path)
    _sent.add(sc.applicationId)


def shipped(f: Callable) -> Callable:
    """``f(spark, ...)`` that ships the package first."""

    @functools.wraps(f)
    def run(spark: SparkSession, *rest):
        ship(spark)
        return f(spark, *rest)

    return run
