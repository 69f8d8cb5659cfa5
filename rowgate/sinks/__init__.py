"""Writers for silver, quarantine and report tables."""
