"""ledgerloom: document-record analytics on Spark."""
