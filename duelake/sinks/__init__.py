"""Writers for bronze datasets, quarantine and catalog tables."""
