"""Sources: catalog manifests, archives, delimited files, seeds."""
