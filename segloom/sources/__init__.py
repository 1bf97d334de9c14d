"""Sources and sinks: files with fixed schemas, and services behind interfaces."""
