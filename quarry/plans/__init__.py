"""The end-to-end pipeline, the registered query catalog and its SQL oracle."""
