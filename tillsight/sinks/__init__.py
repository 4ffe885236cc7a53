"""Where results go: topics, CSV exports, and the detail store."""
