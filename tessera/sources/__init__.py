"""Bronze: where data comes from and how it is written."""
