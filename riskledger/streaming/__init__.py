"""The row-local steps on a stream."""
