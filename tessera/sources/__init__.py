"""Sources (delimited scans with rejects) and sinks (staged table loads)."""

from tessera.sources.delimited import good_rows, read_delimited, rejected_rows
from tessera.sources.sinks import create_namespaces, publish, stamp

__all__ = ["read_delimited", "good_rows", "rejected_rows", "create_namespaces", "publish", "stamp"]
