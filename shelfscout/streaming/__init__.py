"""The nightly load as a file stream."""
