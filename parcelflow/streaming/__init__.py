"""parcelflow.streaming."""
