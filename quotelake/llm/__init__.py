"""Training-data operators over document tables. Nothing else in the package imports this subpackage."""
