"""Sources: raw extract schemas and readers, test-data adapters, table sinks."""

from . import raw, testdata  # noqa: F401
