"""Readers, schemas, sinks and the conformed complaint-domain views."""
