"""Event and support-ticket analytics as plain ``DataFrame -> DataFrame`` functions."""
