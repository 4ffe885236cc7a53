"""Where records come from: topics, CSV exports, and tables of a sales warehouse."""
