"""The query catalogue and the composed retraining cycle."""
