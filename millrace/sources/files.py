"""Directory listings with checksums, and manifests."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files that writers leave beside data: commit markers, locks and checksums of the file system.
IGNORED = r"(^|/)(_SUCCESS|\.[^/]*|[^/]*\.lock)$"
#: Counters that older manifests lack.
LATER_COUNTERS = ("rawParsed", "acceptedProducts", "skippedInvalidBarcode", "skippedMissingName", "skippedMissingNutrition", "skippedValidation", "sortRuns", "dedupedDocs", "indexedDocs", "inputCompressedBytes")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path (below the parent of root, with /), bytes, sha256 of every file, executors doing the hashing."""
    parent = os.path.dirname(os.path.abspath(root))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    relative = F.substring(F.regexp_replace("path", "^file:/*", "/"), len(parent) + 2, 1 << 20)
    listed = files.select(relative.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return listed.where(~F.col("path").rlike(IGNORED)).orderBy("path")


def read_manifest(path: str) -> dict:
    """A manifest with missing later counters as 0."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    return dict.fromkeys(LATER_COUNTERS, 0) | found
