"""The reference has no streaming operator; every job here is a batch job."""
