"""Storage addresses: split, dispatch and compatibility with an environment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address shapes. The access-point form comes before the plain bucket form, which also matches it.
URI_PATTERNS = (
    r"^s3://(arn:aws:s3:[^:]*:[^:]*:accesspoint/[^/]+)(?:/(.*))?$",
    r"^s3://([^/]+)(?:/(.*))?$",
    r"^gs://([^/]+)(?:/(.*))?$",
    r"^azure://([^/]+)(?:/(.*))?$",
    r"^https://[^/]+\.blob\.core\.windows\.net/([^/]+)(?:/(.*))?$",
)
BLOB_HOST = ".blob.core.windows.net/"


def split_uri(uri: Column) -> tuple[Column, Column]:
    """Bucket and prefix; both NULL where no shape matches, prefix ``""`` where there is none."""
    trimmed = F.rtrim(uri, F.lit("/"))

    def part(group: int) -> Column:
        cases = [(trimmed.rlike(p), F.regexp_extract(trimmed, p, group)) for p in URI_PATTERNS]
        return reduce(lambda acc, c: acc.when(*c), cases[1:], F.when(*cases[0]))

    return part(1), part(2)


def storage_kind(uri: Column) -> Column:
    """Which layout check serves the address; ``skip`` where none does."""
    return F.when(uri.startswith("s3://"), "s3").when(uri.startswith("gs://"), "gcs") \
        .when(uri.contains(BLOB_HOST), "azure").otherwise("skip")


def is_compatible(env: Column, uri: Column) -> Column:
    s3, gcs, blob = uri.startswith("s3://"), uri.startswith("gs://"), uri.contains(BLOB_HOST)
    return F.when(env == "byoc-aws", s3).when(env.isin("byoc-gcp", "byoc-azure"), gcs | blob) \
        .when(env == "saas", s3 | gcs | blob).otherwise(F.lit(True))
