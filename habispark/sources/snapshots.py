"""Choice of the latest vintage of a yearly data set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How the yearly commune list is titled, and the file types it comes in.
TITLE_PARTS = ("liste des communes", "au 01/01/")
TITLE_EXCLUDED = "outre-mer"
FILE_TYPES = (".csv", ".csv.gz", ".zip")


def latest_snapshot(manifest: DataFrame) -> DataFrame:
    """The commune list with the last title, then last address; empty if there is none.

    `manifest` has columns `title` and `url`, one row per published resource.
    """
    title = F.lower(F.coalesce("title", F.lit("")))
    kept = ~title.contains(TITLE_EXCLUDED)
    for part in TITLE_PARTS:
        kept &= title.contains(part)
    typed = F.lit(False)
    for suffix in FILE_TYPES:
        typed |= F.col("url").endswith(suffix)
    return (
        manifest.filter(kept & typed)
        .select(title.alias("title"), "url")
        .orderBy(F.col("title").desc(), F.col("url").desc())
        .limit(1)
    )


def latest_snapshot_url(manifest: DataFrame) -> str:
    """The address of the latest commune list, or an error if the manifest names none."""
    found = latest_snapshot(manifest).first()
    if found is None:
        raise LookupError("the manifest names no yearly commune list")
    return found.url
