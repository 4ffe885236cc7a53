"""Column expressions and record codecs; nothing here starts a job."""
