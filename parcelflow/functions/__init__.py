"""parcelflow.functions."""
