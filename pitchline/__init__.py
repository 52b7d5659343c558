"""pitchline: football match-event analytics on PySpark, batch and streaming."""
