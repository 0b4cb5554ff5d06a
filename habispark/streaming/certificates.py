"""Certificate pages as a file stream: each run takes the pages that landed since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from habispark.constants import CERTIFICATE_FIELDS
from habispark.operators.certificates import clean_certificates
from habispark.operators.restrict import certificates_of_postcode
from habispark.operators.skew import written
from habispark.sinks import write_certificates
from habispark.sources import SchemaError, certificate_columns, field_counts, page_maps
from habispark.sources.files import CERTIFICATE_MAPS


def scope_name(postcode: str | None, everything: bool) -> str:
    """'full' or the postal code; a run over everything must be asked for."""
    if postcode:
        return postcode
    if not everything:
        raise ValueError("give a postal code, or ask for everything explicitly")
    return "full"


def checked_certificates(maps: DataFrame, postcode: str | None = None) -> DataFrame | None:
    """Clean certificates of landed pages, stored; None if there are none, an error if a field is in no row.

    One pass over the pages: fields are counted while the rows are converted.
    """
    counts = Observation()
    rows = clean_certificates(certificate_columns(maps.observe(counts, *field_counts())))
    if postcode:
        rows = certificates_of_postcode(rows, postcode)
    rows = written(rows, "certificates")
    found = counts.get
    if not found["rows"]:
        return None
    absent = [field for field, name in CERTIFICATE_FIELDS.items() if not found[name]]
    if absent:
        raise SchemaError(f"certificates: missing fields {sorted(absent)}", sorted(absent))
    return rows


def ingest_new_certificates(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoints: str,
    postcode: str | None = None,
    everything: bool = False,
    multiline: bool = False,
    files_per_batch: int = 1_000,
) -> None:
    """Cleans the new pages of one scope into the certificates table and returns when none is left.

    The checkpoint of the scope records which pages are done. Every micro-batch is a lot of its own, which a
    repeated batch replaces, so a run that stops half-way goes on without loss or duplicates. Pages that
    lack a field altogether stop the run.
    """
    scope = scope_name(postcode, everything)
    pages = (
        spark.readStream.schema(CERTIFICATE_MAPS)
        .option("multiLine", multiline)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )

    def store(batch: DataFrame, number: int) -> None:
        rows = checked_certificates(page_maps(batch), postcode)
        if rows is not None:
            write_certificates(rows, target, scope, f"flux-{number:08d}")

    query = (
        pages.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{checkpoints}/{scope}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
