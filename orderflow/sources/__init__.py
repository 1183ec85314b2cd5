"""Sources and sinks: the derived test feed, wire decoding, table storage."""
