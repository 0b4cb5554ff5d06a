"""Writers; each one replaces what it wrote before."""

from habispark.sinks.tables import (
    certificates_of,
    discard,
    new_version,
    publish,
    published_rows,
    read_published,
    stage,
    write_certificates,
    write_communes,
    write_sales,
)

__all__ = [
    "certificates_of",
    "discard",
    "new_version",
    "publish",
    "published_rows",
    "read_published",
    "stage",
    "write_certificates",
    "write_communes",
    "write_sales",
]
