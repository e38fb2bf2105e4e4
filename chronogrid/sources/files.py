"""Files read whole, one row each, through Spark's own readers; a file that can't be parsed is a row with a reason, not a failed job."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F


def binary(spark: SparkSession, paths, pattern: str | None = None) -> DataFrame:
    """(path, stem, content) of files, in folders of any store that Spark reads."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(paths).select("path", F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("stem"), "content")


def parsed(files: DataFrame, parse: Callable[[bytes], list[tuple]], columns: str) -> DataFrame:
    """(stem, reason, columns...): a row for each item that ``parse`` yields; one row with a reason where it fails, whatever the error."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for stem, content in zip(frame["stem"], frame["content"], strict=True):
                try:
                    rows += [(stem, None, *item) for item in parse(bytes(content))]
                except ValueError as e:
                    rows.append((stem, str(e) or "unreadable", *[None] * len(names)))
                except Exception as e:  # a file of unforeseen form must not end the others' job
                    rows.append((stem, f"{type(e).__name__}: {e}", *[None] * len(names)))
            yield pd.DataFrame(rows, columns=["stem", "reason", *names], dtype=object)

    return files.select("stem", "content").mapInPandas(run, f"stem string, reason string, {columns}")
