"""parcelflow.sources."""
