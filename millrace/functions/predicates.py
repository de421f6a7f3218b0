"""Validity tests as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import unicode_trim

BARCODE = r"^[0-9]{8,32}\z"
DATASET_VERSION = r"^[A-Za-z0-9][A-Za-z0-9_.-]{0,63}\z"
SHA256 = r"^[0-9A-Fa-f]{64}\z"
UNSAFE_PATH = r"(^/)|(^|/)\.\.(/|$)|^\.(/|$)"
#: Fixed patterns of private keys and access tokens that must not be exported.
SECRETS = (r"BEGIN (RSA|OPENSSH|EC|DSA) PRIVATE KEY", r"gho_[A-Za-z0-9_]+", r"github_pat_[A-Za-z0-9_]+")
#: Paths left out of an export: version control, build products, dumps and archives; the kept fixture comes first.
EXPORT_KEEP = ("tests/fixtures/products.jsonl.gz",)
EXPORT_DROP = r"^(\.git|target|\.build)/|\.jsonl$|\.jsonl\.gz$|\.tar\.zst$"
MAX_LINE_BYTES = 16 * 1024 * 1024


def valid_barcode(c: Column) -> Column:
    """8 to 32 ASCII digits after trimming."""
    return F.coalesce(unicode_trim(c).rlike(BARCODE), F.lit(False))


def valid_dataset_version(c: Column) -> Column:
    return F.coalesce(c.rlike(DATASET_VERSION), F.lit(False))


def valid_sha256(c: Column) -> Column:
    return F.coalesce(c.rlike(SHA256), F.lit(False))


def safe_relative_path(c: Column) -> Column:
    return F.coalesce(~c.rlike(UNSAFE_PATH), F.lit(False))


def has_secret(c: Column, patterns: tuple[str, ...] = SECRETS) -> Column:
    return F.coalesce(c.rlike("|".join(f"({p})" for p in patterns)), F.lit(False))


def exported(path: Column) -> Column:
    return path.isin(*EXPORT_KEEP) | ~path.rlike(EXPORT_DROP)


def oversized(line: Column) -> Column:
    """A line that is longer than the limit with its line feed."""
    return F.octet_length(line) + 1 > MAX_LINE_BYTES
