"""Build, verify and package a release: a lookup table, a manifest with checksums, and a reproducible archive."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import tarfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import predicates as P
from millrace.operators import index, metrics
from millrace.operators.dedupe import best_per_key, ordered
from millrace.operators.normalize import SOURCE, normalize, with_rank
from millrace.sources.files import IGNORED, list_files, read_manifest
from millrace.sources.jsonl import parse_lines, prepare, read_lines
from millrace.streaming.progress import Progress

SCHEMA_VERSION = 1
PIPELINE_VERSION = "0.1.0"
MANIFEST = "manifest.json"
INDEX = "index"
CHUNK = 50_000
ZSTD_LEVEL = 6
MIN_INDEX_MEMORY = 15_000_000


class InvalidRelease(Exception):
    """A release, or an option for building one, that doesn't hold together."""


@dataclass
class BuildOptions:
    input: str
    output: str
    dataset_version: str
    artifact: str | None = None
    chunk_size: int = CHUNK
    worker_threads: int = 4
    index_memory: int = 512 * 1024 * 1024
    trace_barcode: str | None = None
    trace_unit: str | None = None

    def check(self) -> None:
        if self.chunk_size <= 0:
            raise InvalidRelease("chunk size must be greater than zero")
        if self.worker_threads <= 0:
            raise InvalidRelease("worker threads must be greater than zero")
        if self.index_memory < self.worker_threads * MIN_INDEX_MEMORY:
            raise InvalidRelease(f"index memory must be at least {MIN_INDEX_MEMORY} bytes for each worker")
        if not re.match(P.DATASET_VERSION.replace(r"\z", r"\Z"), self.dataset_version):
            raise InvalidRelease("invalid dataset version")
        if not os.path.isfile(self.input):
            raise InvalidRelease(f"input is not a file: {self.input}")


def hash_file(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _trace(rows: DataFrame, options: BuildOptions) -> None:
    """With a traced barcode: fail if it is absent, rejected or has another unit than expected."""
    found = rows.where(F.col("barcode") == options.trace_barcode).select("nutrition_basis_unit", "skip_reason").collect()
    if options.trace_unit is None:
        return
    units = {"" if r["skip_reason"] else r["nutrition_basis_unit"] for r in found}
    if units != {options.trace_unit}:
        raise InvalidRelease(f"traced barcode {options.trace_barcode}: expected unit {options.trace_unit!r}, found {sorted(units) or 'no row'}")


def build_release(spark: SparkSession, options: BuildOptions, progress: Progress | None = None) -> dict:
    """Read, normalise, keep the best of each barcode, write the index and the manifest, verify, and package if asked.

    The parsed rows are written once to a working folder beside the output, so that no step parses again; it goes in the
    end. An output that exists is deleted.
    """
    options.check()
    progress = progress or Progress()
    prepare(spark)
    work = options.output.rstrip("/") + ".work"
    for d in (options.output, work):
        shutil.rmtree(d, ignore_errors=True)
    os.makedirs(options.output)
    try:
        progress.set_phase("ingest")
        size = os.path.getsize(options.input)
        progress.update(compressed_total=size)
        parsed = parse_lines(read_lines(spark, options.input))
        normalize(parsed).write.parquet(f"{work}/rows")
        rows = spark.read.parquet(f"{work}/rows")
        counts = metrics.ingest_counters(rows.withColumn("skip_reason", F.when(F.col("parsed"), F.col("skip_reason")))).first().asDict()
        read = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
        short = {k.removesuffix("_products"): v for k, v in counts.items()}
        progress.update(records=counts["input_lines"], compressed_bytes=size, input_bytes=read, **short)
        if options.trace_barcode:
            _trace(rows.where("parsed"), options)
        progress.set_phase("external_sort")
        runs = metrics.sort_runs(counts["accepted_products"], options.chunk_size)
        progress.update(sort_runs=runs)
        progress.set_phase("merge")
        accepted = rows.where("parsed and skip_reason is null").drop("line_no", "bytes", "parsed", "skip_reason")
        ordered(best_per_key(with_rank(accepted)), "barcode").write.parquet(f"{work}/best")
        best = spark.read.parquet(f"{work}/best")
        n = best.count()
        progress.update(deduped_docs=n)
        checksum = metrics.stream_sha256(best.orderBy("barcode"))
        progress.set_phase("index_commit")
        ordered(index.documents(best), "barcode").write.parquet(f"{options.output}/{INDEX}")
        progress.update(indexed_docs=n)
        progress.set_phase("hash")
        files = [r.asDict() for r in list_files(spark, f"{options.output}/{INDEX}").collect()]  # a row for each file
        progress.update(phase_files=len(files), phase_bytes=sum(f["bytes"] for f in files))
        progress.set_phase("manifest")
        manifest = {
            "schemaVersion": SCHEMA_VERSION, "pipelineVersion": PIPELINE_VERSION, "datasetVersion": options.dataset_version, "source": SOURCE, "recordCount": n,
            "inputSha256": hash_file(options.input), "normalizedSha256": checksum, "indexSha256": metrics.files_sha256(files), "inputLines": counts["input_lines"],
            "rawParsed": counts["raw_parsed"], "acceptedProducts": counts["accepted_products"], "invalidLines": counts["invalid_lines"], "skippedProducts": counts["skipped_products"],
            "skippedInvalidBarcode": counts["skipped_invalid_barcode"], "skippedMissingName": counts["skipped_missing_name"], "skippedMissingNutrition": counts["skipped_missing_nutrition"],
            "skippedValidation": counts["skipped_validation"], "sortRuns": runs, "dedupedDocs": n, "indexedDocs": n, "inputCompressedBytes": size, "files": files,
        }
        with open(f"{options.output}/{MANIFEST}", "w", encoding="utf-8") as f:
            json.dump(manifest, f, indent=2, ensure_ascii=False)
        verify_release(spark, options.output, progress)
        if options.artifact:
            _package(options.output, options.artifact, options.worker_threads, progress)
        return manifest
    finally:
        shutil.rmtree(work, ignore_errors=True)


def _safe(path: str) -> bool:
    return not re.search(P.UNSAFE_PATH, path)


def verify_release(spark: SparkSession, release: str, progress: Progress | None = None) -> dict:
    """Check a release against its manifest, the first failure raising; returns the manifest. Extra files are not looked for."""
    (progress or Progress()).set_phase("verify")
    try:
        m = read_manifest(f"{release}/{MANIFEST}")
    except (OSError, ValueError) as e:
        raise InvalidRelease(f"manifest can't be read: {e}") from e
    sha = re.compile(P.SHA256.replace(r"\z", r"\Z"))
    if m.get("schemaVersion") != SCHEMA_VERSION or m.get("source") != SOURCE:
        raise InvalidRelease("manifest schema version or source is not supported")
    if not str(m.get("pipelineVersion", "")).strip() or not re.match(P.DATASET_VERSION.replace(r"\z", r"\Z"), m.get("datasetVersion", "")) or m.get("recordCount", 0) <= 0:
        raise InvalidRelease("manifest versions or record count are invalid")
    root = f"{release}/{INDEX}"
    if os.path.islink(root) or not os.path.isdir(root):
        raise InvalidRelease("index is not a directory")
    if not all(sha.match(m.get(k, "")) for k in ("inputSha256", "normalizedSha256", "indexSha256")):
        raise InvalidRelease("manifest checksum is invalid")
    for f in m["files"]:
        if not _safe(f["path"]) or not sha.match(f["sha256"]):
            raise InvalidRelease(f"manifest file entry is invalid: {f['path']}")
    if metrics.files_sha256(m["files"]) != m["indexSha256"].lower():
        raise InvalidRelease("index checksum does not match its files")
    for f in m["files"]:
        path = f"{release}/{f['path']}"
        if os.path.islink(path) or not os.path.isfile(path) or os.path.getsize(path) != f["bytes"]:
            raise InvalidRelease(f"file is missing or has another size: {f['path']}")
    named = spark.createDataFrame([(f["path"], f["sha256"].lower()) for f in m["files"]], "path string, expected string")
    bad = list_files(spark, root).join(named, "path", "right").where("sha256 is null or sha256 <> expected").limit(1).collect()
    if bad:
        raise InvalidRelease(f"file checksum does not match: {bad[0]['path']}")
    store = spark.read.parquet(root)
    if missing := [c for c in index.REQUIRED if c not in store.columns]:
        raise InvalidRelease(f"index lacks fields: {', '.join(missing)}")
    if store.count() != m["recordCount"]:
        raise InvalidRelease("index document count does not match the manifest")
    return m


def package_release(spark: SparkSession, release: str, artifact: str, threads: int | None = None, progress: Progress | None = None) -> None:
    """Verify, then write the archive."""
    verify_release(spark, release, progress)
    _package(release, artifact, threads or os.cpu_count() or 1, progress or Progress())


def _members(release: str) -> list[str]:
    """index/ depth first with names in order, the manifest last."""
    out: list[str] = []

    def walk(folder: str) -> None:
        for name in sorted(os.listdir(f"{release}/{folder}"), key=str.encode):
            path = f"{folder}/{name}"
            if os.path.islink(f"{release}/{path}"):
                raise InvalidRelease(f"not a regular file: {path}")
            if os.path.isdir(f"{release}/{path}"):
                walk(path)
            elif not re.search(IGNORED, path):
                out.append(path)

    walk(INDEX)
    return [*out, MANIFEST]


def _package(release: str, artifact: str, threads: int, progress: Progress) -> None:
    """A reproducible tar (no owners, no times, fixed order) compressed with zstd, flushed to disk."""
    import zstandard

    progress.set_phase("package")
    with open(artifact, "wb") as raw:
        with zstandard.ZstdCompressor(level=ZSTD_LEVEL, threads=threads).stream_writer(raw, closefd=False) as packed, tarfile.open(fileobj=packed, mode="w|", format=tarfile.USTAR_FORMAT) as tar:
            for path in _members(release):
                if len(path.encode()) > 100:
                    raise InvalidRelease(f"path is too long for the archive: {path}")
                info = tarfile.TarInfo(path)
                info.size, info.mode = os.path.getsize(f"{release}/{path}"), 0o640
                with open(f"{release}/{path}", "rb") as f:
                    tar.addfile(info, f)
        raw.flush()
        os.fsync(raw.fileno())
