"""claimcheck: a Spark engine that audits trade claims made in chat channels."""

__version__ = "0.1.0"
