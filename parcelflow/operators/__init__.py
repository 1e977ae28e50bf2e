"""parcelflow.operators."""
