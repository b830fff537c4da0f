"""Scans and sinks: raw CSV, layer databases, overwrite / partitioned tables,
and the binding of the shared test tables to the raw warehouse inputs."""
