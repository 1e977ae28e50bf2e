"""parcelflow.sinks."""
