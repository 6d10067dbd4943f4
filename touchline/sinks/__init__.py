"""Sinks: layer-table writers (batch and streaming) and the message publisher."""
