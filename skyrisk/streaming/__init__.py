"""The daily refresh as an incremental file source."""
