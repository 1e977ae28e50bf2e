"""parcelflow.plans."""
