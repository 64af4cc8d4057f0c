"""Reading manifests and writing accepted records."""
